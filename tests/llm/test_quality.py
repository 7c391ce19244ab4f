import random
import zlib

import numpy as np

from latticework.llm import quality

SCHEMA = "doc_id long, text string"


def corpus(n=900, seed=2):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(15, 90))]
        if not good:
            words = rng.choice([[w + "%%%" for w in words], words[:3] * 20, [w.upper() + "!!" for w in words]])
        docs.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return docs, labels


def tables(spark, docs, labels):
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    rows, truth = corpus()
    docs, labels = tables(spark, rows, truth)
    truth = dict(truth)
    scored = quality.score(docs, quality.train(docs, labels)).withColumn("held", quality.held_out()).collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    held = [r for r in scored if r.held]
    assert len(held) > 150
    assert sum((r.score >= 0.7) == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_held_out_labels_are_not_seen(spark):
    rows, truth = corpus(300)
    docs, labels = tables(spark, rows, truth)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in truth]
    x = quality.table_of([t.encode() for _, t in rows])
    one = quality.train(docs, labels).probability(x)
    other = quality.train(docs.repartition(5), tables(spark, rows, flipped)[1]).probability(x)
    assert np.array_equal(one, other)


def slow_margin(trees, row):
    total = trees.start
    for t in range(len(trees.features)):
        at = 0
        while at < trees.features.shape[1]:
            at = 2 * at + 1 + int(row[trees.features[t, at]] > trees.borders[t, at])
        total += trees.values[t, at - trees.features.shape[1]]
    return total


def test_arrays_walk_like_trees():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x, y, n_trees=30)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.97
    assert np.allclose(trees.margin(x[:50]), [slow_margin(trees, r) for r in x[:50]])


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 9.0), (None, "", 9.0), (2, "a b", None), (2, "a b", None)], SCHEMA + ", score double"
    )
    for labels in ([], [(2, 1)], [(2, None), (None, 1)]):
        model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = quality.score(docs, model)
        assert got.columns == ["doc_id", "text", "score"]
        assert all(0 < r.score < 1 for r in got.collect()) and got.count() == 4
    assert quality.score(docs.limit(0), model).collect() == []
    assert quality.statistics(b"x" * 5_000_000, quality.hasher(), quality.Windows(3))[2] == 5_000_000


def test_texts_are_sent_once(spark):
    docs = spark.createDataFrame([(1, "a b c", 4), (2, None, 5)], "doc_id long, text string, more int")
    model = quality.fit(np.zeros((0, len(quality.FEATURES)), np.float32), np.zeros(0))
    scored = quality.score(docs, model)
    sent = scored._jdf.queryExecution().analyzed().children().apply(0).output()
    assert sent.size() == len(docs.columns)
    want = [(r.doc_id, r.text, r.more, r.score) for r in scored.collect()]
    assert [row[:3] for row in want] == [(1, "a b c", 4), (2, None, 5)]
    # A field of a struct and another case work too.
    nested = docs.selectExpr("doc_id", "struct(text) AS s", "more")
    assert [r.score for r in quality.score(nested, model, "s.text").collect()] == [row[3] for row in want]
    assert quality.score(docs, model, "TEXT").columns == ["doc_id", "text", "more", "score"]
