"""Registered queries: file readers as round trips, and the even split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.operators import inclusion
from latticework.operators.split import even_split as split_evenly
from latticework.plans.inclusion import cells_sql
from latticework.plans.inputs import (
    ALL_TABLES, MAX_HINTS, RECORDS_SQL, STAR_TABLES, record_file_rows, table, tables,
)
from latticework.session import scratch_dir
from latticework.sources import records as record_files
from latticework.sources import tables as table_files
from latticework.streaming.runs import run_available

N_RANGES = 7


def write_record_files(rows: DataFrame, path: str) -> None:
    """Records as files, spread over the session's partitions.

    Beside each record of an even number, lines of other lengths: one cut after the name, and one with a
    field too many.
    """
    dialect = record_files.Dialect()
    options = {"sep": dialect.separator, "quote": dialect.quote, "escape": dialect.escape, "header": True}
    rows.repartition("id").write.options(**options).csv(path)
    even = rows.where("id % 2 = 0")
    even.select("id", "name").write.mode("append").options(**options).csv(path)
    even.withColumn("more", F.lit("x")).write.mode("append").options(**options).csv(path)


def write_strict_files(rows: DataFrame, path: str) -> None:
    """Records as lines whose texts are quoted, with signs outside the quotes that do not belong to them.

    Names hold a separator, quotes and an escape sign. Nulls are unquoted signs. Beside each record of an even
    number are lines of other lengths, and one that ends inside quotes.
    """
    named = rows.withColumn("name", F.concat("name", F.lit(';"x"\\')))

    def field(name: str):
        text = F.col(name).cast("string")
        for sign in ("\\", '"'):
            text = F.replace(text, F.lit(sign), F.lit("\\" + sign))
        return F.coalesce(F.concat(F.lit(' out "'), text, F.lit('"side')), F.lit(" nothing "))

    lines = named.repartition("id").select("id", F.concat_ws(";", *map(field, named.columns)).alias("line"))
    even = lines.where("id % 2 = 0").select(
        F.explode(F.array(F.concat("line", F.lit(';"more"')), F.lit('"cut";"line"'), F.concat("line", F.lit('"')))).alias("line")
    )
    lines.select("line").write.text(path)
    even.write.mode("append").text(path)


def _read_schema(schema: T.StructType) -> T.StructType:
    """The types of a table as its files hold them: nested columns are text."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType) for f in schema.fields]
    )


def _with_odd_texts(name: str, df: DataFrame) -> DataFrame:
    """The benchmark texts get a leading blank, quotes, a separator and a line break, or are null or empty."""
    if name != "benchmark":
        return df
    odd = F.concat(F.lit(' "'), F.col("text"), F.lit('";\n'))
    return df.withColumn("text", F.when(F.col("item_id") % 4 == 1, odd).when(
        F.col("item_id") % 4 == 2, F.lit("")).when(F.col("item_id") % 4 == 3, F.lit(None)).otherwise(F.col("text")))


def read_tables(spark, sf_dir):
    """All tables as CSV files and back, with types inferred for the star tables; all cells, equal
    ones counted.

    Texts hold quotes, separators, blanks, line breaks and nulls beside empty ones.
    """
    root = scratch_dir(spark, "tables")
    given = tables(spark, sf_dir, ALL_TABLES)
    for name, df in given.items():
        table_files.write_table(_with_odd_texts(name, df), f"{root}/{name}.csv", **table_files.PACKED)
    # Texts that look like numbers stay texts.
    schemas = {name: _read_schema(df.schema) for name, df in given.items() if name not in STAR_TABLES}
    rows = inclusion.cells(table_files.read_tables(spark, root, schemas))
    return rows.groupBy("attr", "value").agg(F.count(F.lit(1)).alias("n_cells"))


def read_records(spark, sf_dir):
    path = scratch_dir(spark, "record-files")
    write_record_files(record_file_rows(spark, sf_dir), path)
    return record_files.read_records(spark, record_files.record_schema(MAX_HINTS), path)


def read_records_strict(spark, sf_dir):
    """Record files in which only what is quoted counts."""
    path = scratch_dir(spark, "strict-files")
    write_strict_files(record_file_rows(spark, sf_dir), path)
    dialect = record_files.Dialect(strict_quotes=True, has_header=False)
    return record_files.read_records(spark, record_files.record_schema(MAX_HINTS), path, dialect)


def stream_read_records(spark, sf_dir):
    path = scratch_dir(spark, "record-files")
    write_record_files(record_file_rows(spark, sf_dir), path)
    schema = record_files.record_schema(MAX_HINTS)
    return run_available(record_files.stream_records(spark, schema, path, files_per_batch=2), "records")


def even_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return split_evenly(orders, ["o_orderdate", "o_orderkey"], N_RANGES).select("o_orderkey", "range_no")


QUERIES = {
    "read_tables": read_tables,
    "read_records": read_records,
    "read_records_strict": read_records_strict,
    "stream_read_records": stream_read_records,
    "even_split": even_split,
}

_RECORD_ROWS = f"""WITH {RECORDS_SQL},
hint_list AS (SELECT id, list(sha256(hint) ORDER BY hint_ix) AS h FROM rec_hint GROUP BY id)
SELECT v.id, v.name, v.alphabet, 8 AS plen, sha256(v.value) AS value_hash,
       {', '.join(f'h[{i}] AS hint_{i}' for i in range(1, MAX_HINTS + 1))}
FROM rec_value v JOIN hint_list USING (id)"""

ORACLES = {
    "read_tables": f"""WITH {cells_sql([t for t in ALL_TABLES if t != 'benchmark'])},
odd AS (SELECT CAST(item_id AS VARCHAR) AS item_id, CASE item_id % 4 WHEN 1 THEN ' "' || text || '";' || chr(10)
  WHEN 2 THEN '' WHEN 3 THEN NULL ELSE text END AS text FROM benchmark),
every AS (
  SELECT * FROM cells
  UNION ALL SELECT 'benchmark.item_id', item_id FROM odd
  UNION ALL SELECT 'benchmark.text', text FROM odd WHERE text IS NOT NULL)
SELECT attr, value, count(*) AS n_cells FROM every GROUP BY attr, value""",
    "read_records": _RECORD_ROWS,
    "read_records_strict": f"""SELECT * REPLACE (name || ';"x"\\' AS name) FROM ({_RECORD_ROWS})""",
    "stream_read_records": _RECORD_ROWS,
    "even_split": f"""SELECT o_orderkey,
       CAST(ntile({N_RANGES}) OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS range_no FROM orders""",
}
