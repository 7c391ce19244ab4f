"""Joins that stay balanced if one key holds much of the data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until none of ``taken`` is the same in any case."""
    known = {other.lower() for other in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``rows`` with a ``table`` that is unique on ``keys``.

    Adaptive execution splits a hot key of ``rows`` only if both sides are shuffled
    for the join itself. A table that was aggregated on the same keys would keep its
    partitions instead, so a hash of the keys joins along with them, under a name that neither side has.
    """
    name = fresh("key_hash", [*rows.columns, *table.columns])
    key_hash = F.xxhash64(*keys).alias(name)
    joined = rows.select("*", key_hash).join(table.select("*", key_hash), [name, *keys], how)
    return joined.drop(name)
