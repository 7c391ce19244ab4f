"""Registered queries: inclusion dependencies over all tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from latticework.operators import inclusion as ops
from latticework.plans.inputs import ALL_TABLES, COLUMNS, tables


def ind_cells(spark, sf_dir):
    """All cells of all tables, equal ones counted."""
    rows = ops.cells(tables(spark, sf_dir, ALL_TABLES))
    return rows.groupBy("attr", "value").agg(F.count(F.lit(1)).alias("n_cells"))


def ind_attribute_sets(spark, sf_dir):
    sets = ops.attribute_sets_of(tables(spark, sf_dir, ALL_TABLES))
    return sets.select("value", F.array_join("aset", ", ").alias("aset"))


def ind_pairs(spark, sf_dir):
    return ops.shared_value_counts(tables(spark, sf_dir, ALL_TABLES))


def ind_unary(spark, sf_dir):
    return ops.ind_rows(ops.unary_inds(tables(spark, sf_dir, ALL_TABLES)))


def ind_report(spark, sf_dir):
    return ops.report(ops.unary_inds(tables(spark, sf_dir, ALL_TABLES)))


QUERIES = {
    "ind_cells": ind_cells,
    "ind_attribute_sets": ind_attribute_sets,
    "ind_pairs": ind_pairs,
    "ind_unary": ind_unary,
    "ind_report": ind_report,
}


# An array of floats as JSON: below a thousandth with an exponent, as Spark writes it.
_FLOAT = """CASE WHEN abs(x) >= 0.001 OR x = 0 THEN CAST(x AS VARCHAR)
  WHEN contains(CAST(x AS VARCHAR), 'e') THEN regexp_replace(regexp_replace(regexp_replace(
    CAST(x AS VARCHAR), 'e-0?', 'E-'), '^(-?[0-9])E', '\\1.0E'), 'E-0', 'E-')
  ELSE (CASE WHEN x < 0 THEN '-' ELSE '' END) || regexp_replace(regexp_replace(
    CAST(x AS VARCHAR), '^-?0\\.0*([0-9])([0-9]*)$', '\\1.\\2'), '\\.$', '.0')
    || 'E-' || (length(regexp_extract(CAST(x AS VARCHAR), '^-?0\\.(0*)', 1)) + 1) END"""
_TEXTS = {"embedding": f"'[' || array_to_string(list_transform(embedding, lambda x: {_FLOAT}), ',') || ']'"}


def cells_sql(names: list[str]) -> str:
    """CTE ``cells(attr, value)`` over the columns of the tables."""
    parts = [
        f"SELECT '{name}.{column}' AS attr, {_TEXTS.get(column, f'CAST({column} AS VARCHAR)')} AS value "
        f"FROM {name} WHERE {column} IS NOT NULL"
        for name in names
        for column in COLUMNS[name]
    ]
    return "cells AS (" + "\nUNION ALL\n".join(parts) + ")"


_CELLS = cells_sql(ALL_TABLES)
_SHARED = f"""{_CELLS},
uniq AS (SELECT DISTINCT attr, value FROM cells),
shared AS (
  SELECT d.attr AS dep, r.attr AS ref, count(*) AS n_shared
  FROM uniq d JOIN uniq r ON d.value = r.value AND d.attr <> r.attr GROUP BY 1, 2),
sizes AS (SELECT attr, count(*) AS n FROM uniq GROUP BY attr),
inds AS (SELECT dep, ref FROM shared JOIN sizes ON attr = dep WHERE n_shared = n)
"""

ORACLES = {
    "ind_cells": f"WITH {_CELLS} SELECT attr, value, count(*) AS n_cells FROM cells GROUP BY attr, value",
    "ind_attribute_sets": f"""WITH {_CELLS}
SELECT value, string_agg(attr, ', ' ORDER BY attr) AS aset
FROM (SELECT DISTINCT attr, value FROM cells) GROUP BY value""",
    "ind_pairs": f"WITH {_SHARED} SELECT dep, ref, n_shared FROM shared",
    "ind_unary": f"WITH {_SHARED} SELECT dep, ref FROM inds",
    "ind_report": f"""WITH {_SHARED}
SELECT dep, CAST(count(*) AS INTEGER) AS n_refs, dep || ' < ' || string_agg(ref, ', ' ORDER BY ref) AS line
FROM inds GROUP BY dep ORDER BY dep""",
}
