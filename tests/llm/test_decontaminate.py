import random
import re

import pytest
from pyspark.sql import functions as F

from latticework.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[at : at + size]), set()).add(name)
    out = []
    for doc_id, text in docs:
        words, hit, names = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                found = windows.get(tuple(words[at : at + size]))
                if found:
                    hit.update(range(at, at + size))
                    names |= {str(n) for n in found if n is not None}
        out.append((doc_id, len(words), len(hit), sorted(names)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


def made(seed, n_docs=60, vocabulary=12):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "b", "c1", "é", "D", "日", "x-y", "ab"] + [f"w{i}" for i in range(vocabulary)])
    items = []
    for i in range(14):
        items.append((rng.choice([i, i, 3, None]), " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))))
    items += [(20, None), (21, "...")]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randrange(4)):
            words += [word() for _ in range(rng.randrange(30))]
            source = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(source) + 1)
            words += source[a : a + rng.randrange(1, 20)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    return docs + [(100, None), (101, ""), (None, docs[3][1]), (5, docs[5][1])], items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("shard_bytes", [1 << 20, 150])
def test_equals_brute_force(spark, seed, shard_bytes):
    docs, items = made(seed)
    got = D.contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), window=4 if seed == 3 else 10, shard_bytes=shard_bytes
    )
    want = brute(docs, items, 4 if seed == 3 else 10)
    assert result(got) == want
    assert sum(r[2] > 0 for r in want) > 5


def test_longest_matches_of_the_automaton():
    rng = random.Random(7)
    items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 15))).encode()) for i in range(6)]
    machine = D.Automaton(items, 5)
    texts = [t.decode().split() for _, t in items]
    factors = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
    words = [rng.choice("abc") for _ in range(300)]
    _, matched = machine.walk([machine.words[w.encode()] for w in words])
    for end, length in enumerate(matched.tolist(), 1):
        assert tuple(words[end - length : end]) in factors
        assert length == end or tuple(words[end - length - 1 : end]) not in factors


def test_spans_go_and_covered_documents_too(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], ITEMS)
    hit = "One, two three. Four five six seven eight nine - TEN"
    rows = [(1, f"Before it; {hit}! After it, and so on and on and on and on."), (2, hit + " more"), (3, "clean  Text."), (4, None), (5, "")]
    got = D.decontaminate(spark.createDataFrame(rows, DOCS), items)
    found = sorted(tuple(r) for r in got.collect())
    assert found == [
        (1, "Before it; ! After it, and so on and on and on and on.", 23, 10), (3, "clean  Text.", 2, 0), (4, None, 0, 0), (5, "", 0, 0)
    ]
    assert got.columns == ["id", "text", "n_words", "n_hit"]


def test_empty_tables_and_clashing_names(spark):
    docs, items = spark.createDataFrame([(1, "a b", 4)], DOCS + ", hits int"), spark.createDataFrame([], ITEMS)
    assert result(D.contamination(docs, items)) == [(1, 2, 0, [])]
    assert D.contamination(docs.limit(0), items).collect() == []
    items = spark.createDataFrame([(1, "b")], ITEMS).withColumns({c: F.lit("z") for c in ("name", "bucket", "part")})
    docs = docs.withColumns({c: F.lit("z") for c in ("id", "n_words", "items")})
    assert result(D.contamination(docs, items)) == [(1, 2, 1, ["1"])]


def test_very_long_texts_and_repeated_passages(spark):
    rng = random.Random(2)
    item = [f"w{rng.randrange(50)}" for _ in range(400)]
    words = []
    for _ in range(300):
        words += [f"v{rng.randrange(10**6)}" for _ in range(500)] + item[:200]
    got = D.contamination(
        spark.createDataFrame([(1, " ".join(words)), (2, "w1 " * 100_000)], DOCS),
        spark.createDataFrame([(7, " ".join(item)), (8, "w1 " * 30)], ITEMS),
    )
    assert result(got) == [(1, 210_000, 60_000, ["7"]), (2, 100_000, 100_000, ["8"])]
