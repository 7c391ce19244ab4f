"""CSV files as a set of tables, and sinks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.operators.joins import lookup
from latticework.session import materialize

# Fixed value: field separator of the table files.
TABLE_SEPARATOR = ";"

_PARALLEL_READS = 8
ROWS_PER_FILE = 1_000_000

# How tables are written and read: quotes inside a quoted field are doubled, an unquoted empty field is
# null and ``""`` the empty text, white space stays, and a quoted field may go on over several lines.
# The null marker cannot occur in a text file.
TABLE_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_READ_OPTIONS = TABLE_OPTIONS | {"nullValue": "\u0000", "emptyValue": ""}
_WRITE_OPTIONS = TABLE_OPTIONS | {"nullValue": "", "emptyValue": '""'}
# Options of :func:`write_table` for compressed files. They hold fewer rows, as they are not split. The lowest level costs
# little time.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100_000}


def list_tables(spark: SparkSession, directory: str) -> dict[str, str]:
    """``{name: path}`` of the files and folders right below ``directory``.

    Spark lists the files; only the distinct entry names reach the driver. The name of a table
    is its entry without the ``.csv`` ending; two entries of one name are an error.
    """
    root = directory.rstrip("/")
    # The path as the file system writes it in the paths of its files.
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    qualified = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    prefix = qualified.toString().rstrip("/") + "/"
    below_root = F.substr(F.col("path"), F.lit(len(prefix) + 1))
    entries = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.col("path").startswith(F.lit(prefix)).alias("below"), F.substring_index(below_root, "/", 1).alias("entry"))
        .distinct()
        .orderBy("entry")
        .collect()
    )
    if not all(row["below"] for row in entries):
        raise ValueError(f"files of {root} are listed under another path than {prefix}")
    names = [row["entry"] for row in entries]
    twice = [n for n, k in Counter(name.removesuffix(".csv") for name in names).items() if k > 1]
    if twice:
        raise ValueError(f"tables of one name in {root}: {twice}")
    return {name.removesuffix(".csv"): f"{root}/{name}" for name in names}


def read_tables(
    spark: SparkSession,
    source: str | Mapping[str, str],
    schemas: Mapping[str, T.StructType] | None = None,
    sep: str = TABLE_SEPARATOR,
    **options,
) -> dict[str, DataFrame]:
    """One DataFrame per table of a directory or of a ``{name: path}`` map.

    Header names; types are inferred from all rows, which costs one pass per table,
    unless ``schemas`` names the type of a table. Line breaks, quotes, blanks and empty texts inside
    fields are read as :func:`write_table` writes them.

    Files that are not compressed are split, whatever they hold: a pass over the quotes tells whether any line ends inside a
    field. If none does, the lines are the records; else :func:`records` finds these and stores them once. With
    ``multiLine=False`` there is no such pass, and no field may hold a line break; with ``multiLine=True`` a file is one task.
    """
    paths = list_tables(spark, source) if isinstance(source, str) else dict(source)

    def read(name: str) -> DataFrame:
        reader = spark.read.options(sep=sep, **_READ_OPTIONS | options)
        schema = (schemas or {}).get(name)
        typed = reader.schema(schema) if schema is not None else reader.options(inferSchema=True)
        found = None if "multiLine" in options else records(spark, paths[name])
        if found is None:
            return typed.csv(paths[name])
        # The first record of a file names the columns.
        first = found.where("first").orderBy("file").select("value").limit(1)
        names = schema.fieldNames() if schema is not None else _parsed(reader, first).columns
        return _parsed(typed.option("header", False), found.where("NOT first").select("value")).toDF(*names)

    # Inference runs a job per table; small tables share the cluster meanwhile.
    with ThreadPoolExecutor(_PARALLEL_READS) as pool:
        return dict(zip(paths, pool.map(read, paths)))


def _parsed(reader, values: DataFrame) -> DataFrame:
    """Records, each a text of one column, as ``reader`` reads the lines of a file."""
    spark = values.sparkSession
    texts = getattr(values._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(texts), spark)


def records(spark: SparkSession, path: str, quote: str = TABLE_OPTIONS["quote"]) -> DataFrame | None:
    """(file, first, value): the records of the files at ``path``, which may go on over lines inside quotes.

    None if no line has an odd number of quotes, so that lines are records. ``first`` marks the
    first record of a file. Quotes inside quotes are doubled, so whether a line starts inside a field is the parity of all
    quotes before it in its file. Quotes are summed by file split; a running sum over the splits, one
    row each, gives the parity where a split begins; inside a split lines are numbered in their order. A record that
    goes on in the next split is put together from one piece a split. No task holds more than a split
    and one record. Records inside a split are stored once, the others in their pieces and as a whole.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    if lines.where(F.contains("value", F.lit(quote)) & (quotes % 2 == 1)).isEmpty():
        return None
    splits = materialize(lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd")), "table-splits")
    of_file = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("odd").over(of_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    borders = splits.select("file", "block", before.alias("inside"), ((before + F.col("odd")) % 2).alias("goes_on"))

    split = Window.partitionBy("file", "block")
    ordered = split.orderBy("pos")
    earlier = F.coalesce(F.sum(quotes).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ((F.col("inside") + earlier) % 2 == 0).cast("long")
    placed = lookup(lines, borders, ["file", "block"], "inner").withColumn("starts", starts)
    placed = placed.withColumn("number", F.sum("starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))

    def joined(entries: str) -> Column:
        return F.array_join(F.transform(F.array_sort(entries), lambda e: e["value"]), "\n")

    pieces = placed.groupBy("file", "block", "number", "goes_on").agg(
        F.collect_list(F.struct("pos", "value")).alias("entries")
    )
    last = F.max("number").over(split)
    pieces = materialize(
        pieces.select(
            "file", "block", "number", joined("entries").alias("value"),
            ((F.col("number") == 0) | (F.col("goes_on") == 1) & (F.col("number") == last)).alias("cut"),
        ),
        "table-pieces",
        compression="zstd",
    )
    # Two pieces a split at most; a record begins with a piece that has a number.
    chain = F.sum((F.col("number") > 0).cast("long")).over(of_file.orderBy("block", "number"))
    stitched = materialize(
        pieces.where("cut")
        .select("file", F.struct("block", "number", "value").alias("piece"), chain.alias("chain"))
        .groupBy("file", "chain")
        .agg(F.array_sort(F.collect_list("piece")).alias("entries"))
        .select(
            "file",
            F.array_join(F.transform("entries", lambda e: e["value"]), "\n").alias("value"),
            ((F.col("entries")[0]["block"] == 0) & (F.col("entries")[0]["number"] == 1)).alias("first"),
        ),
        "table-records",
        compression="zstd",
    )
    whole = pieces.where("NOT cut").withColumn("first", (F.col("block") == 0) & (F.col("number") == 1))
    found = whole.select("file", "first", "value").unionByName(stitched)
    # A record may end with the line break of another system.
    return found.withColumn("value", F.regexp_replace("value", "\r$", ""))


def write_table(df: DataFrame, path: str, sep: str = TABLE_SEPARATOR, **options) -> None:
    """Write a table in the form :func:`read_tables` reads, nested columns as JSON and binary ones as hex.

    One file a task, each of ``ROWS_PER_FILE`` rows at most; with the options ``PACKED`` compressed, in smaller files.
    """
    df.select(*(_as_field(f) for f in df.schema.fields)).write.options(
        **{"sep": sep, "maxRecordsPerFile": ROWS_PER_FILE} | _WRITE_OPTIONS | options
    ).csv(path)


def _as_field(field: T.StructField) -> Column:
    column = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column).alias(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column).alias(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        # Spark's own format of CSV files ends at milliseconds.
        return column.cast("string").alias(field.name)
    return column


def write_report(report: DataFrame, path: str) -> None:
    """Write the ``line`` column of a dependency report as text."""
    report.select("line").write.text(path)


def write_results(results: DataFrame, path: str) -> None:
    """Collect results as Parquet."""
    results.write.parquet(path)
