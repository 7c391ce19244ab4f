import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from latticework.llm import periodic
from latticework.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def brute(words, least=6, power=4):
    n, found = len(words), []
    for q in range(1, n // power + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(least, power * q):
                root = words[start : start + length]
                if all(any(root[i] != root[i + p] for i in range(length - p)) for p in range(1, q)):
                    found.append((start, length, q))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbers(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(5)):
            words += [rng.choice("abcdefg"[: rng.randrange(1, 8)]) for _ in range(rng.randrange(12))]
            words += [rng.choice("abc") for _ in range(rng.randrange(1, 7))] * rng.randrange(1, 7)
        for least, power in ((6, 4), (2, 2), (5, 3)):
            got = [tuple(r) for r in periodic.runs_of(numbers(words), least, power).tolist()]
            assert got == brute(words, least, power), words


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 40, 300])
def test_minima(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 50, n).astype(np.int32)
    a, b = rng.integers(0, n, (2, 500))
    first, last = np.minimum(a, b), np.maximum(a, b)
    want = [values[x : y + 1].min() for x, y in zip(first, last)]
    assert periodic.Minima(values).of(first, last).tolist() == want


def test_extensions_of_suffixes():
    rng = random.Random(3)
    words = [rng.randrange(3) for _ in range(200)]
    tree = periodic.SuffixTree(np.array(words)).prepare()
    pairs = [(a, b) for a in range(200) for b in range(0, 200, 7) if a != b]
    want = []
    for a, b in pairs:
        k = 0
        while max(a, b) + k < 200 and words[a + k] == words[b + k]:
            k += 1
        want.append(k)
    assert tree.extension(*np.array(pairs).T).tolist() == want
    order = sorted(range(201), key=lambda i: words[i:])
    assert np.argsort(tree.ranks()).tolist() == order
    falling = sorted(range(201), key=lambda i: [-w for w in words[i:]])
    assert np.argsort(tree.ranks(falling=True)).tolist() == falling


def test_rows_nulls_and_clashing_names(spark):
    rows = [(1, "x a b a b\na b a b y", "k"), (1, "x a b a b\na b a b y", "k"), (None, "é é é é é é", None), (3, None, ""), (4, " \n", "")]
    docs = spark.createDataFrame(rows, SCHEMA + ", runs string").withColumn("id", docs_id()).withColumn("collapsed", docs_id())
    got = periodic.periodic_runs(docs)
    assert got.columns == ["id", "runs", "collapsed"]
    found = sorted(((r.id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr)
    assert found == sorted(
        [(1, [(1, 8, 2)], "x a b y"), (1, [(1, 8, 2)], "x a b y"), (None, [(0, 6, 1)], "é"), (3, [], ""), (4, [], "")], key=repr
    )
    assert periodic.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def docs_id():
    from pyspark.sql import functions as F

    return F.lit("other")


def test_very_long_texts(spark):
    rng = random.Random(5)
    plain = [f"w{rng.randrange(30_000)}" for _ in range(150_000)]
    period = [f"p{i}" for i in range(9_000)]
    rows = [(1, " ".join(plain + period * 5 + plain[:1000])), (2, "a " * 120_000)]
    got = {r.id: r for r in periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(x) for x in got[1].runs] == [(150_000, 45_000, 9_000)]
    assert got[1].collapsed == " ".join(plain + period + plain[:1000])
    assert [tuple(x) for x in got[2].runs] == [(0, 120_000, 1)] and got[2].collapsed == "a"


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_equals_brute_force(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = fast_brute(words)
        some += len(runs) > 0
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        text_of_runs = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert got[doc_id] == (
            doc_id, len(runs), *(best or (None, None, None)), best and best[1] * 1000 // best[2],
            hashlib.sha256(text_of_runs.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        )
    assert some > 5


def fast_brute(words, least=6, power=4):
    """As ``brute``, by comparing the words with themselves moved by each period."""
    ids, found = numbers(words), []
    for q in range(1, len(ids) // power + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(int)
        starts, ends = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for start, end in zip(starts.tolist(), ends.tolist()):
            length = end - start + q
            if length >= max(least, power * q):
                part = ids[start : start + length]
                if not any((part[:-p] == part[p:]).all() for p in range(1, q)):
                    found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))
