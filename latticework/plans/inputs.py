"""Inputs of the registered queries, derived from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latticework.functions.hashing import sha256_hex

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
ALL_TABLES = STAR_TABLES + [
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Columns of each table, for the oracle SQL.
COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}

PLEN = 8
MAX_HINTS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}


# --- sets of order keys -------------------------------------------------------


def line_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set per line number: the orders that have such a line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("set_id"), F.col("l_orderkey").alias("bit")
    )


def priority_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set per priority number: the orders of that priority."""
    return table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("set_id"),
        F.col("o_orderkey").alias("bit"),
    )


def order_line_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set per order: its line numbers."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("set_id"), F.col("l_linenumber").cast("bigint").alias("bit")
    )


SETS_SQL = """
line_sets AS (SELECT DISTINCT l_linenumber AS set_id, l_orderkey AS bit FROM lineitem),
priority_sets AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS set_id, o_orderkey AS bit FROM orders),
order_line_sets AS (SELECT DISTINCT l_orderkey AS set_id, CAST(l_linenumber AS BIGINT) AS bit FROM lineitem)
"""


# --- records with a hashed value and hashed hints ------------------------------


def _symbol(alphabet: Column, position: Column) -> Column:
    return F.substring(alphabet, position.cast("int") + F.lit(1), F.lit(1))


def plain_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per customer, in plain form.

    The alphabet is the letters of the market segment. Two of its symbols, chosen by
    the customer key, make up the value; each hint is the alphabet without one of the
    other symbols, rotated.
    """
    key = F.col("id")
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.sort_array(F.array_distinct(F.split("c_mktsegment", ""))).alias("letters"),
    )
    n = F.size("letters").cast("bigint")
    first = key % n
    second = (first + F.lit(1) + F.call_function("div", key, n) % (n - 1)) % n
    base = base.select(
        "id", "name", "letters",
        F.array_join("letters", "").alias("alphabet"),
        n.cast("int").alias("n"),
        first.cast("int").alias("a_pos"),
        second.cast("int").alias("b_pos"),
    )
    a, b = _symbol(F.col("alphabet"), F.col("a_pos")), _symbol(F.col("alphabet"), F.col("b_pos"))
    value = F.concat(
        *[F.when(F.shiftright("id", i).bitwiseAND(F.lit(1)) == 0, a).otherwise(b) for i in range(PLEN)]
    )
    others = F.filter("letters", lambda s: (s != a) & (s != b))

    def hint(symbol: Column, j: Column) -> Column:
        rest = F.replace(F.col("alphabet"), symbol, F.lit(""))
        turn = ((key + j) % (F.col("n") - 1)).cast("int")
        return F.concat(F.substring(rest, turn + 1, F.col("n")), F.substring(rest, F.lit(1), turn))

    return base.select(
        "id", "name", "alphabet", F.lit(PLEN).alias("plen"), value.alias("value"),
        F.transform(others, hint).alias("hints"),
    )


def _hashed(plain: DataFrame) -> DataFrame:
    return plain.withColumns(
        {"value_hash": sha256_hex(F.col("value")), "hints": F.transform("hints", sha256_hex)}
    )


def hashed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as the search jobs take them."""
    return _hashed(plain_records(spark, sf_dir)).select(
        "id", "alphabet", "plen", "value_hash", "hints"
    )


def record_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in the layout of a record file, with one column per hint."""
    hints = [F.get("hints", F.lit(i)).alias(f"hint_{i + 1}") for i in range(MAX_HINTS)]
    return _hashed(plain_records(spark, sf_dir)).select(
        "id", "name", "alphabet", "plen", "value_hash", *hints
    )


RECORDS_SQL = """
rec_letters AS (
  SELECT c_custkey AS id, c_name AS name, list_sort(list_distinct(string_split(c_mktsegment, ''))) AS letters
  FROM customer),
rec_base AS (
  SELECT id, name, letters, array_to_string(letters, '') AS alphabet, len(letters) AS n,
         id % len(letters) AS a_pos,
         (id % len(letters) + 1 + (id // len(letters)) % (len(letters) - 1)) % len(letters) AS b_pos
  FROM rec_letters),
rec_pair AS (
  SELECT *, substr(alphabet, CAST(a_pos + 1 AS BIGINT), 1) AS a, substr(alphabet, CAST(b_pos + 1 AS BIGINT), 1) AS b
  FROM rec_base),
rec_value AS (
  SELECT *, array_to_string(list_transform(range(8), lambda i: CASE WHEN (id >> i) & 1 = 0 THEN a ELSE b END), '') AS value
  FROM rec_pair),
rec_hint_base AS (
  SELECT v.id, v.alphabet, v.n, u.symbol,
         row_number() OVER (PARTITION BY v.id ORDER BY u.symbol) AS hint_ix
  FROM rec_value v, unnest(v.letters) AS u(symbol)
  WHERE u.symbol <> v.a AND u.symbol <> v.b),
rec_hint AS (
  SELECT id, CAST(hint_ix AS INTEGER) AS hint_ix, symbol AS excluded,
         substr(replace(alphabet, symbol, ''), CAST((id + hint_ix - 1) % (n - 1) + 1 AS BIGINT)) ||
         substr(replace(alphabet, symbol, ''), 1, CAST((id + hint_ix - 1) % (n - 1) AS BIGINT)) AS hint
  FROM rec_hint_base)
"""
