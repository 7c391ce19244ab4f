"""Approximate nearest neighbours by a permutation index: pivots, inverted files, footrule, rerank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latticework.session import materialize

# Pivots at most, and how many of the nearest a vector is known by.
PIVOTS, NEAREST = 128, 64
# Rows of a shard of the index, and queries that meet a shard at once.
SHARD_ROWS, QUERY_ROWS = 8192, 2048
# Of each shard, the share of rows with the least footrule distance to a query, and how many at least, that are
# measured exactly. More rows are if they tie.
SHARE, AT_LEAST = 0.15, 500

_INDEX = "shard int, ids array<long>, vectors array<double>, borders array<int>, members array<int>, ranks array<short>"


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vector) of the rows that take part: all but null ids and vectors, zero vectors, vectors with
    a component that is null or not finite, and vectors of another length than most have."""
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0))


def pivots_of(rows: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """The unit vectors of ``n`` rows with distinct vectors, fewer if there are, by a hash of the vector."""
    chosen = rows.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(n).collect()
    return _unit(np.array([r["vector"] for r in chosen], np.float64))


def _unit(x: np.ndarray) -> np.ndarray:
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _permutations(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """For each vector its nearest pivots, nearest first; ties go to the earlier pivot."""
    return np.argsort(-(_unit(x) @ pivots.T), axis=1, kind="stable")[:, :nearest]


def _vectors(table: pa.Table, name: str) -> np.ndarray:
    lists = table.column(name).combine_chunks()
    return np.asarray(lists.flatten()).reshape(len(lists), -1)


def _invert(pivots: np.ndarray, nearest: int):
    def run(key, rows):
        """The inverted files of a shard: by pivot, its rows and the pivot's rank in each."""
        order = np.argsort(np.asarray(rows.column("id")), kind="stable")
        ids, x = np.asarray(rows.column("id"))[order], _vectors(rows, "vector")[order]
        found = _permutations(x, pivots, nearest)
        member, rank = np.divmod(np.arange(found.size), found.shape[1])
        by_pivot = np.argsort(found.ravel(), kind="stable")
        borders = np.searchsorted(found.ravel()[by_pivot], np.arange(len(pivots) + 1))
        columns = [[key[0].as_py()], [ids], [x.ravel()], [borders], [member[by_pivot]], [rank[by_pivot]]]
        kinds = [pa.int32(), *(pa.list_(k) for k in (pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int16()))]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _INDEX.split(", ")])

    return run


def build_index(
    rows: DataFrame, pivots: np.ndarray, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The index of all ``rows`` (id, vector), one row a shard of about ``shard_rows`` vectors, stored.

    A shard holds its ids and vectors and an inverted file for each pivot: the members that have it
    among their ``nearest`` nearest, and at which rank. Shards are even, by a hash of row and id.
    """
    n_shards = max(1, -(-rows.count() // shard_rows))
    shard = F.pmod(F.xxhash64("id", "vector"), F.lit(n_shards)).cast("int")
    return materialize(
        rows.withColumn("shard", shard).groupBy("shard").applyInArrow(_invert(pivots, nearest), _INDEX), "ann-index"
    )


def _search(pivots: np.ndarray, nearest: int, k: int, share: float, at_least: int):
    kinds = [("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]

    def run(key, index, queries):
        out = [[], [], []]
        if index.num_rows and queries.num_rows:
            ids, members, ranks, borders = (
                np.asarray(index.column(c).combine_chunks().flatten()) for c in ("ids", "members", "ranks", "borders")
            )
            x = np.asarray(index.column("vectors").combine_chunks().flatten()).reshape(len(ids), -1)
            norms = np.sqrt((x * x).sum(axis=1))
            q = _vectors(queries, "vector")
            most = min(nearest, len(pivots))
            n = max(at_least, int(np.ceil(share * len(ids))))
            for query_id, v, pivot_order in zip(
                queries.column("id").to_pylist(), q, _permutations(q, pivots, nearest).tolist()
            ):
                # The footrule distance is a constant less twice this sum over the pivots both have.
                near = np.zeros(len(ids), np.int32)
                for rank, pivot in enumerate(pivot_order):
                    own = slice(borders[pivot], borders[pivot + 1])
                    near[members[own]] += most - np.maximum(ranks[own], rank)
                near[ids == query_id] = -1
                least = max(0, np.partition(near, -n)[-n] if n < len(near) else 0)
                at = np.flatnonzero(near >= least)
                scores = (x[at] * v).sum(axis=1) / (norms[at] * np.sqrt((v * v).sum()))
                best = np.lexsort((ids[at], -scores))[:k]
                out[0] += [query_id] * len(best)
                out[1] += ids[at[best]].tolist()
                out[2] += scores[best].tolist()
        return pa.table([pa.array(c, kind) for c, (_, kind) in zip(out, kinds)], names=[name for name, _ in kinds])

    return run


def search(
    index: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int = 5, nearest: int = NEAREST,
    share: float = SHARE, at_least: int = AT_LEAST, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of each of ``queries`` (id, vector), all if fewer.

    Blocks of queries meet shards of the index, each pair in one call, which ranks the shard by footrule
    distance through the inverted files and measures the best ``share`` of it exactly: cosine in
    double precision. Rows with the query's id are no candidates; ties go to the smaller id. Of equal queries
    (repeated rows) one counts.
    """
    n_blocks = max(1, -(-queries.count() // query_rows))
    shards = index.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0] + 1
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    keyed = queries.dropDuplicates(["id"]).select(
        "id", "vector", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"), every(shards, "shard")
    )
    found = (
        index.select("*", every(n_blocks, "block"))
        .groupBy("shard", "block")
        .cogroup(keyed.groupBy("shard", "block"))
        .applyInArrow(_search(pivots, nearest, k, share, at_least), "query_id long, id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def nearest_neighbours(
    vectors: DataFrame, is_query, id: str = "vec_id", vector: str = "embedding", k: int = 5
) -> DataFrame:
    """(query_id, rank, id, score) for the rows of ``vectors`` where ``is_query`` (on the column id) holds.

    Pivots come from ``PIVOTS`` rows at most; every usable row is indexed. Rows that are not usable take no
    part; of repeated queries one counts, repeated candidates count each; other columns are not read. No
    rows: no rows.
    """
    rows = usable(vectors, id, vector)
    pivots = pivots_of(rows)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    return search(build_index(rows, pivots), rows.where(is_query), pivots, k)
