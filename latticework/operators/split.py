"""Even split of an ordered table into contiguous ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.session import materialize

# A row id is the partition number shifted by 33 bits plus the row number in it.
_ROW_BITS = 33

_UNORDERED = (T.MapType, T.VariantType)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def global_rank(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0) by ``order`` and ``total``.

    Rows that tie on ``order`` are ordered by their other columns, which also spreads a
    key that many rows share over several partitions of the sort.

    The table is sorted by range partitions and stored once, so that partition and row
    number are frozen; ranks then follow from the row counts of the partitions.
    """
    ties = [
        f.name
        for f in df.schema.fields
        if f.name not in order and not isinstance(f.dataType, _UNORDERED)
    ]
    placed = materialize(
        df.orderBy(*order, *ties).withColumn("row_id", F.monotonically_increasing_id()), "rank"
    )
    part = F.shiftright("row_id", _ROW_BITS)
    row = F.col("row_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per partition of the sort.
    everything = Window.orderBy("part")
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(whole).alias("total"),
    )
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn("rank", F.col("offset") + row)
        .drop("part", "offset", "row_id")
    )


def even_split(df: DataFrame, order: Sequence[str], n_ranges: int) -> DataFrame:
    """``df`` with ``range_no`` from 1: ``n_ranges`` contiguous ranges whose sizes
    differ by at most one, the larger ones first."""
    if n_ranges < 1:
        raise ValueError("n_ranges must be at least 1")
    ranked = global_rank(df, order)
    rank, ranges = F.col("rank"), F.lit(n_ranges)
    base, extra = _div(F.col("total"), ranges), F.col("total") % ranges
    in_large = extra * (base + 1)
    number = F.when(rank < in_large, _div(rank, base + 1)).otherwise(
        extra + _div(rank - in_large, F.greatest(base, F.lit(1)))
    )
    return ranked.select(*df.columns, (number + 1).cast("int").alias("range_no"))


def range_borders(split: DataFrame, order: str) -> DataFrame:
    """``(range_no, first, last, n_rows)`` of an even split."""
    return split.groupBy("range_no").agg(
        F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n_rows")
    )
