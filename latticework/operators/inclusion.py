"""Unary inclusion dependencies between the columns of a set of tables.

An attribute ``dep`` is included in ``ref`` if every value of ``dep`` also
occurs in ``ref``. Values are compared as text, nested ones as JSON and binary ones as
hex; nulls carry no value.

The job keeps, per distinct value, a bit mask of the attributes it occurs in.
A mask is a fixed-width aggregate, so the only shuffle that grows with the data
is one hash aggregation on the value with full map-side combine. Equal masks are
then grouped; what is left is at most as many rows as there are distinct
attribute sets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.functions.arrays import each
from latticework.functions.bits import WORD_BITS, WORD_SHIFT, long_lit

# Where no value is returned, texts longer than this meet by their SHA-256.
DIGEST_OVER = 64


def attribute_name(table: str, column: str, qualify: bool) -> str:
    return f"{table}.{column}" if qualify else column


def _text_of(field: T.StructField) -> str:
    """SQL of a column as text."""
    name = _quoted(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return f"to_json({name})"
    return f"hex({name})" if isinstance(field.dataType, T.BinaryType) else f"cast({name} as string)"


def attribute_list(tables: Mapping[str, DataFrame], qualify: bool = True) -> list[str]:
    """Sorted attribute names; the position of a name is its number."""
    names = {
        attribute_name(table, column, qualify)
        for table, df in tables.items()
        for column in df.columns
    }
    return sorted(names)


def _union_cells(tables: Mapping[str, DataFrame], tag_of: Callable[[str, str], str]) -> DataFrame:
    """``(tag, value)`` for every non-null cell; the cells are cast to text, column by column."""
    parts = []
    for table, df in tables.items():
        if not df.columns:
            continue
        tags = [tag_of(table, c) for c in df.columns]
        texts = df.selectExpr(*[f"{_text_of(f)} as {_quoted(t)}" for f, t in zip(df.schema.fields, tags)])
        parts.append(texts.unpivot([], [_quoted(t) for t in tags], "tag", "value"))
    # Pairwise, since every union is analysed again with all it contains.
    while len(parts) > 1:
        parts = [reduce(DataFrame.union, parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0].where(F.col("value").isNotNull())


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cells(tables: Mapping[str, DataFrame], qualify: bool = True) -> DataFrame:
    """One row ``(attr, value)`` per non-null cell of every table."""
    rows = _union_cells(tables, lambda t, c: attribute_name(t, c, qualify))
    return rows.withColumnRenamed("tag", "attr")


def attribute_sets(cell_rows: DataFrame) -> DataFrame:
    """``(value, aset)``: the sorted attributes each value occurs in.

    Repeated cells are removed first, with map-side combine, so a value that
    fills a third of all cells still reaches its group once per attribute.
    """
    return (
        cell_rows.select("attr", "value")
        .distinct()
        .groupBy("value")
        .agg(F.sort_array(F.collect_list("attr")).alias("aset"))
    )


def _mask_columns(n_attributes: int) -> list[str]:
    return [f"mask_{w}" for w in range(-(-n_attributes // WORD_BITS))]


def value_masks(
    tables: Mapping[str, DataFrame], qualify: bool = True, digest_over: int | None = None
) -> DataFrame:
    """``(value, mask_0, ...)``: one row per distinct value.

    With ``digest_over`` the SHA-256 of the whole text stands in for values longer
    than that many characters, which keeps long texts out of the shuffle.
    """
    names = attribute_list(tables, qualify)
    number = {name: i for i, name in enumerate(names)}
    rows = _union_cells(tables, lambda t, c: str(number[attribute_name(t, c, qualify)]))
    rows = rows.select(F.col("tag").cast("int").alias("attr_no"), "value")
    keys = ["value"]
    if digest_over is not None:
        is_long = F.length("value") > F.lit(digest_over)
        rows = rows.select(
            "attr_no",
            is_long.alias("digested"),
            F.when(is_long, F.sha2("value", 256)).otherwise(F.col("value")).alias("value"),
        )
        keys = ["digested", "value"]
    position = (F.col("attr_no") % F.lit(WORD_BITS)).cast("int")
    bit = F.call_function("shiftleft", long_lit(1), position)
    word = F.shiftright("attr_no", WORD_SHIFT)
    masks = _mask_columns(len(names))
    if len(masks) == 1:
        rows = rows.select(*keys, bit.alias(masks[0]))
    else:
        rows = rows.select(
            *keys,
            *[F.when(word == F.lit(w), bit).otherwise(long_lit(0)).alias(m) for w, m in enumerate(masks)],
        )
    return rows.groupBy(*keys).agg(*[F.bit_or(m).alias(m) for m in masks])


def attribute_set_counts(
    tables: Mapping[str, DataFrame], qualify: bool = True, digest_over: int | None = None
) -> DataFrame:
    """``(mask_0, ..., n_values)``: distinct attribute sets and their number of values."""
    masks = _mask_columns(len(attribute_list(tables, qualify)))
    return (
        value_masks(tables, qualify, digest_over)
        .groupBy(*masks)
        .agg(F.count(F.lit(1)).alias("n_values"))
    )


def _names_in(masks: list[str], names: list[str], skip: Column | None = None) -> Column:
    """Names of the set bits as an array, in name order."""
    words, every = F.array(*masks), F.array(*[F.lit(name) for name in names])

    def is_set(name: Column, i: Column) -> Column:
        word = F.get(words, F.shiftright(i, WORD_SHIFT))
        return F.call_function("bit_get", word, F.call_function("mod", i, F.lit(WORD_BITS))) == 1

    found = F.filter(every, is_set)
    return found if skip is None else F.array_remove(found, skip)


def _members(df: DataFrame, masks: list[str], names: list[str], as_name: str) -> DataFrame:
    return df.withColumn(as_name, each(_names_in(masks, names)))


def attribute_sets_of(tables: Mapping[str, DataFrame], qualify: bool = True) -> DataFrame:
    """Same result as ``attribute_sets(cells(tables))``, by way of masks."""
    names = attribute_list(tables, qualify)
    masks = _mask_columns(len(names))
    return value_masks(tables, qualify).select("value", _names_in(masks, names).alias("aset"))


def shared_value_counts(
    tables: Mapping[str, DataFrame], qualify: bool = True, digest_over: int | None = DIGEST_OVER
) -> DataFrame:
    """``(dep, ref, n_shared)``: number of distinct values each two attributes share.

    Pairs are formed per distinct attribute set, never per value; a set has at
    most as many members as there are columns.
    """
    names = attribute_list(tables, qualify)
    masks = _mask_columns(len(names))
    sets = attribute_set_counts(tables, qualify, digest_over).select(
        "n_values", _names_in(masks, names).alias("aset")
    )
    pairs = sets.select("n_values", "aset", each("aset").alias("dep")).select(
        "n_values", "dep", each("aset").alias("ref")
    )
    return (
        pairs.where(F.col("dep") != F.col("ref"))
        .groupBy("dep", "ref")
        .agg(F.sum("n_values").alias("n_shared"))
    )


def unary_inds(
    tables: Mapping[str, DataFrame], qualify: bool = True, digest_over: int | None = DIGEST_OVER
) -> DataFrame:
    """``(dep, refs)``: attributes with the sorted attributes they are included in.

    The references of an attribute are the intersection (``bit_and``) of all
    attribute sets it belongs to, for any number of attributes; no pairs are formed.
    """
    names = attribute_list(tables, qualify)
    masks = _mask_columns(len(names))
    sets = attribute_set_counts(tables, qualify, digest_over)
    common = (
        _members(sets, masks, names, "dep")
        .groupBy("dep")
        .agg(*[F.bit_and(m).alias(m) for m in masks])
    )
    return common.select("dep", _names_in(masks, names, skip=F.col("dep")).alias("refs")).where(
        F.size("refs") > 0
    )


def ind_rows(inds: DataFrame) -> DataFrame:
    """One row ``(dep, ref)`` per dependency."""
    return inds.select("dep", each("refs").alias("ref"))


def report(inds: DataFrame) -> DataFrame:
    """Sorted report with one line ``dep < ref1, ref2`` per dependent attribute."""
    line = F.concat(F.col("dep"), F.lit(" < "), F.concat_ws(", ", "refs"))
    return inds.select("dep", F.size("refs").alias("n_refs"), line.alias("line")).orderBy("dep")
