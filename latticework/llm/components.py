"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticework.operators.joins import lookup
from latticework.session import materialize


def _stars(pairs: DataFrame) -> DataFrame:
    """Hangs the neighbours of each node on the smallest of them; ``pairs`` is (node, other)."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return lookup(pairs, least, ["node"], "inner")


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that it reaches.

    Alternates large and small stars until the links stay the same, which takes a number of rounds
    that grows with the logarithm of a chain's length. Each round is written to the shared scratch
    folder, so that no lineage grows and a lost executor costs one round. A node with very many
    neighbours is pre-aggregated and its join split. Links with a null, and of a node with itself,
    say nothing. No links: no rows.
    """
    proper = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    links = materialize(
        links.where(proper).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    state = None
    while True:
        seen = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == state or not seen["n"]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = (seen["n"], seen["s"])
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        # Large star: larger neighbours go to the smallest neighbour, which may be the node itself.
        large = _stars(both).where("other > node").select(
            F.col("other").alias("a"), F.least("node", "least").alias("b")
        )
        large = materialize(large.distinct(), label)
        # Small star: the node and its smaller neighbours go to the smallest of them.
        small = _stars(large.select(F.col("a").alias("node"), F.col("b").alias("other")))
        links = small.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
            small.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
        links = materialize(links.where("a != b").distinct(), label)
