"""Running sums over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latticework.operators.joins import lookup

# Rows of a group that one window call may hold, as a power of two.
BLOCK_SHIFT = 16


def begun(rows: DataFrame, group: str, order: str, size: str, order_bits: int = 64) -> DataFrame:
    """``(group, order, begun)``: the sum of ``size`` over the rows of the group that come earlier.

    ``rows`` are unique on ``group`` and ``order``, both without nulls; ``order`` is a non-negative integer of
    at most ``order_bits`` bits. Sums are taken inside blocks of ``2^BLOCK_SHIFT`` places, then over the
    blocks in the same way, so no task holds a group. Null sizes count as none.
    """
    last = order_bits <= BLOCK_SHIFT
    keys = [group] if last else [group, "upper"]
    narrow = rows.select(group, F.col(order).cast("long").alias("place"), F.col(size).cast("long").alias("size"))
    narrow = narrow.withColumn("upper", F.shiftright("place", BLOCK_SHIFT))
    earlier = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = narrow.withColumn("begun", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    if not last:
        blocks = narrow.groupBy(group, "upper").agg(F.sum("size").alias("size"))
        above = begun(blocks, group, "upper", "size", order_bits - BLOCK_SHIFT)
        inside = lookup(inside, above.withColumnsRenamed({"begun": "above"}), [group, "upper"])
        inside = inside.withColumn("begun", F.col("begun") + F.coalesce("above", F.lit(0)))
    return inside.select(group, F.col("place").alias(order), "begun")
