import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from latticework.llm import queries, quality
from tests.llm import test_mixing, test_simhash, test_substring

SF = "/root/testdata/sf0.001"


def brute_domain(source):
    return ["web", "books", "code", "news"][int(re.search(r"\d+$", source)[0]) % 4]


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = {r.doc_id: r for r in quality.score(docs, model).collect()}
    good = {i: r for i, r in scored.items() if r.score >= 0.7}
    groups = test_simhash.brute([(i, r.text) for i, r in good.items()])
    single = sorted(i for i, _, component in groups if i == component)
    texts = {}
    for i, n_words, n_removed, kept in test_substring.brute([(i, good[i].text) for i in single]):
        if not n_removed or n_removed < n_words:
            texts[i] = kept if n_removed else good[i].text
    rows = [
        (i, f"{brute_domain(good[i].source)}/{good[i].lang}", good[i].source, len(t.encode().split()))
        for i, t in texts.items()
    ]
    # The three levels in two steps: domains and languages by rounds, as sources weigh what they supply.
    supply = Counter()
    for i, path, source, n in rows:
        supply[path, source] += n
    total = sum(supply.values())
    domains = {p.split("/")[0] for p, _ in supply}
    capacity = lambda keep: 4 * sum(n for (p, _), n in supply.items() if keep(p))
    tops = test_mixing.fill(
        int(queries.BUDGET * total), {d: (queries.DOMAINS[d], capacity(lambda p: p.startswith(d))) for d in domains}
    )
    weights, scale = {}, int(queries.BUDGET * total)
    for d, b in tops.items():
        paths = {p for p, _ in supply if p.startswith(d)}
        below = test_mixing.fill(
            b, {p: (queries.LANGUAGES[p.split("/")[1]], capacity(lambda q: q == p)) for p in paths}
        )
        weights |= {p: given / scale for p, given in below.items()}
    copies = test_mixing.brute(rows, weights, sum(weights.values()) * scale / total + 1e-12, 4, 42)

    vocabulary = Tokenizer.from_file(queries.vocabulary())
    want = {}
    for (_, _, i), n in copies.items():
        if n:
            ids = vocabulary.encode(texts[i], add_special_tokens=False).ids + [queries.PACKED_END]
            want[i] = (n, np.array(ids, "<u4").tobytes())
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    off = {i for i in want.keys() | got.keys() if sum(len(x) for _, x in got.get(i, [])) != want.get(i, (0, b""))[0] * len(want.get(i, (0, b""))[1])}
    assert not off
    for i, (n, ids) in want.items():
        held = np.zeros(len(ids) // 4, int)
        for start, piece in got[i]:
            assert ids[4 * start : 4 * start + len(piece)] == piece
            held[start : start + len(piece) // 4] += 1
        assert (held == n).all()


def test_other_columns_go_along(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["score", "N_Words", "kept_text", "n_removed", "domain", "n_tokens", "__text", "key"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide = docs.select("*", *(F.concat(F.lit(f"{n}:"), "doc_id").alias(n) for n in names))
        result = stage(spark, wide, SF)
        assert result.columns == wide.columns
        rows = result.collect()
        assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_filter", "near_dedup", "substring_dedup", "mix", "pack"]
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, empty, SF)
        assert result.collect() == []
        if name != "pack":
            assert result.columns == docs.columns
    odd = [(None, None, None, None, None), (1, "", "en", "src1", 0), (1, "", "en", "src1", 0), (2, "a b " * 30, None, "x", 9)]
    rows = spark.createDataFrame(odd, docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, rows, SF).collect()


def test_batches_are_small(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "src1", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    wide = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    key = corpus_pipeline.BATCH_SETTING
    try:
        spark.conf.unset(key)
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF)
            found = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
            assert sum(found) >= 30_000_000 and max(found) <= corpus_pipeline.BATCH_BYTES + 200_000
            spark.conf.unset(key)
        spark.conf.set(key, "1234567")
        corpus_pipeline.prepare(spark)
        assert spark.conf.get(key) == "1234567"
    finally:
        spark.conf.unset(key)
