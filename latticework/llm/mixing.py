"""Mixing sources to target weights: budgets down a tree, token prefixes of seeded epochs at the leaves."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latticework.operators.joins import fresh, lookup
from latticework.session import materialize

# Hexadecimal digits of the order key that make a bucket: 65,536 buckets a leaf.
BUCKET_DIGITS = 4
SEED, MAX_EPOCHS = 42, 4


@dataclass(frozen=True)
class Level:
    """A column of the tree. ``weights`` are by value, those not named have ``default``; without
    ``weights`` a value weighs what it supplies."""

    column: str
    weights: dict[str, float] | None = None
    default: float = 0.0

    def weight(self, supply: Column) -> Column:
        if self.weights is None:
            return supply.cast("double")
        found = F.lit(float(self.default))
        for value, weight in self.weights.items():
            found = F.when(F.col(self.column) == value, F.lit(float(weight))).otherwise(found)
        return found


def budgets(leaves: DataFrame, levels: list[Level], budget: int, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (a column a level, supply) with target: the tokens that each leaf shall give.

    A leaf can give ``max_epochs`` times its supply, an inner node what those of its leaves can that have weight on
    their whole path. From the root down,
    a node's budget goes to its children by weight; what a child cannot give goes to its siblings by
    their weights, and only what all of them cannot give was never sent down, since the siblings of the node
    took it before. Among children ordered by capacity over weight, the level that fills is
    ``max_i (B - capacity of those before i) / (weight of i and those after)``, and a child gets that times its
    weight, its capacity at most. Children without weight get nothing.

    Rows here are nodes of the tree, never documents.
    """
    columns = [level.column for level in levels]
    # Weights by value are known at the leaves; supplies are never zero here.
    weighed = [level.weight(F.col("supply")) > 0 for level in levels if level.weights is not None]
    able = functools.reduce(lambda a, b: a & b, weighed, F.lit(True))
    nodes = leaves.withColumn("capacity", F.when(able, F.col("supply") * max_epochs).otherwise(F.lit(0)))
    given = None
    for depth, level in enumerate(levels):
        path, parent = columns[: depth + 1], columns[:depth]
        level_nodes = nodes.groupBy(*path).agg(F.sum("supply").alias("supply"), F.sum("capacity").alias("capacity"))
        level_nodes = level_nodes.withColumn("weight", level.weight(F.col("supply"))).where("weight > 0")
        if given is None:
            level_nodes = level_nodes.withColumn("given", F.lit(float(budget)))
        else:
            upper = given.select(*(F.col(c).alias(f"__{c}") for c in parent), "given")
            same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in parent]
            level_nodes = level_nodes.join(upper, same).drop(*(f"__{c}" for c in parent))
        ordered = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), level.column)
        before = F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        after = F.sum("weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        filled = level_nodes.withColumn("filled", (F.col("given") - before) / after)
        filled = filled.withColumn("filled", F.max("filled").over(Window.partitionBy(*parent)))
        given = filled.select(*path, F.least("capacity", F.col("filled") * F.col("weight")).alias("given"), "supply")
    # A millionth of a token more, so that a whole number that sums of doubles miss stays whole.
    return given.select(*columns, "supply", F.floor(F.col("given") + 1e-6).cast("long").alias("target"))


def copies(
    docs: DataFrame,
    levels: list[Level],
    tokens: str = "n_tokens",
    id: str = "doc_id",
    budget: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """(level columns, id, tokens, copies): how often each document of ``docs`` is in the mixture.

    The mixture has ``budget`` times the tokens of ``docs``, shared out by ``budgets``. A leaf gives whole
    epochs, then the prefix of one more that fits the rest of its target: documents in the order of the MD5
    of seed, epoch and id, a new order each epoch. The running sum of a leaf is taken over buckets of the
    order first, then within buckets, so that no task holds a leaf.

    Repeated rows of one id and leaf are one document of their tokens together; a null id is one document.
    Null tokens are none, and documents without tokens are in each epoch that takes their place. Null
    values of a level are nodes like others (of its default weight). No rows: no rows.
    """
    columns = [level.column for level in levels]
    keys = [f"__{c}" for c in columns]
    counted = docs.select(*columns, F.col(id).cast("long").alias(id), F.col(tokens).cast("long").alias("tokens"))
    units = counted.groupBy(*columns, id).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    # Narrow rows, read several times.
    units = materialize(units, "mixing")
    leaves = units.groupBy(*columns).agg(F.sum("tokens").alias("supply"))
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("n")).first()["n"]
    targets = budgets(leaves.where("supply > 0"), levels, int(budget * total), max_epochs)
    targets = targets.withColumn("whole", F.floor(F.col("target") / F.col("supply")).cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("supply"))
    # Keys that are never null.
    named = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("")).alias(k) for c, k in zip(columns, keys)]
    units = lookup(units.select("*", *named), targets.select(*named, "whole", "rest"), keys)
    units = units.withColumn("whole", F.coalesce("whole", F.lit(0))).withColumn("rest", F.coalesce("rest", F.lit(0)))
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole"), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    units = units.withColumn("place", place).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = units.groupBy(*keys, "bucket").agg(F.sum("tokens").alias("in_bucket"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.select(*keys, "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("begun"))
    within = Window.partitionBy(*keys, "bucket").orderBy("place", id)
    ends = units.withColumn("own", F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.join(begun, [*keys, "bucket"])
    taken = ((F.col("rest") > 0) & (F.col("begun") + F.col("own") <= F.col("rest"))).cast("long")
    return ends.select(*columns, id, "tokens", (F.col("whole") + taken).alias("copies"))


def mix(docs: DataFrame, levels: list[Level], tokens: str = "n_tokens", id: str = "doc_id", **settings) -> DataFrame:
    """``docs``, each row as often as ``copies`` says. All columns stay, whatever their names; rows of a document that
    is in no epoch go."""
    found = copies(docs, levels, tokens, id, **settings).where("copies > 0")
    columns = [level.column for level in levels]
    # One hash of the key joins along, so that null parts meet and a hot id can be split.
    key = F.sha2(F.concat_ws("|", *(F.coalesce(F.hex(F.col(c).cast("string")), F.lit("-")) for c in [*columns, id])), 256)
    named, times, copy = (fresh(name, docs.columns) for name in ("key", "copies", "copy"))
    return (
        docs.withColumn(named, key)
        .join(found.select(key.alias(named), F.col("copies").alias(times)), named)
        .select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))).alias(copy))
        .drop(copy)
    )


def number_domain(source: str = "source", names: tuple[str, ...] = ("web", "books", "code", "news")) -> Column:
    """A domain for sources that are numbered: the number modulo the number of domains; others are ``other``."""
    number = F.regexp_extract(F.col(source), r"([0-9]{1,9})$", 1)
    found = F.lit("other")
    for i, name in enumerate(names):
        found = F.when((number != "") & (number.try_cast("int") % len(names) == i), F.lit(name)).otherwise(found)
    return found


def word_tokens(text: str = "text") -> Column:
    """Words of the whole text, as an estimate of its tokens; none for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
