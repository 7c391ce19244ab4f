import numpy as np
import pytest
from pyspark.sql import functions as F

from latticework.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def data(n=3000, dims=32, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dims))
    x = (centres[rng.integers(20, size=n)] * 0.6 + rng.normal(size=(n, dims))).astype(np.float32)
    x[n // 2] = x[n // 2 + 1]
    return x


def brute(ids, x, queries, k=5):
    x = x.astype(np.float64)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    out = {}
    for i in queries:
        scores = (unit * unit[list(ids).index(i)]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), scores[j]) for j in order]
    return out


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark, monkeypatch):
    x = data()
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    usable = ann.usable(df)
    pivots = ann.pivots_of(usable)
    index = ann.build_index(usable, pivots, shard_rows=700)
    assert index.count() == 5
    assert sorted(i for r in index.collect() for i in r.ids) == list(range(3000))
    got = result(ann.search(index, usable.where("id % 50 = 0"), pivots, at_least=20, query_rows=25))
    want = brute(np.arange(3000), x, range(0, 3000, 50))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    exact = {(q, i): s for q in want for i, s in want[q]}
    for q, found in got.items():
        assert all(s == pytest.approx(exact[q, i], abs=1e-12) for i, s in found if (q, i) in exact)


def test_small_sets_are_exact(spark):
    x = data(400)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    got = result(ann.nearest_neighbours(df, F.col("id") % 50 == 0))
    want = brute(np.arange(400), x, range(0, 400, 50))
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items()}


def test_footrule_equals_its_definition():
    rng = np.random.default_rng(2)
    pivots = ann._unit(rng.normal(size=(12, 8)))
    a, b = (ann._permutations(rng.normal(size=(1, 8)), pivots, 5)[0].tolist() for _ in range(2))
    rank = lambda order, p: order.index(p) if p in order else 5
    footrule = sum(abs(rank(a, p) - rank(b, p)) for p in range(12))
    shared = sum(5 - max(a.index(p), b.index(p)) for p in a if p in b)
    assert footrule == 2 * 15 - 2 * shared


def test_unusable_rows_and_ties(spark):
    rows = [
        (0, [1.0, 0.0], 1), (7, [2.0, 0.0], 1), (3, [5.0, 0.0], 1), (50, [0.0, 1.0], 1), (1, None, 1), (2, [0.0, 0.0], 1),
        (4, [None, 1.0], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (100, None, 1), (None, [1.0, 1.0], 1),
        (8, [1.0, 2.0, 3.0], 1), (50, [0.0, 1.0], 1), (150, [-1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", rank int")
    got = result(ann.nearest_neighbours(df, F.col("id") % 50 == 0))
    assert got[0] == [(3, 1.0), (7, 1.0), (50, 0.0), (50, 0.0), (150, -1.0)]
    assert set(got) == {0, 50, 150}
    assert [i for i, _ in got[50]] == [0, 3, 7, 150]
    assert result(ann.nearest_neighbours(df.limit(0), F.col("id") % 50 == 0)) == {}
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert result(ann.nearest_neighbours(one, F.col("id") % 50 == 0)) == {}
