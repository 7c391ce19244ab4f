"""Record files with a full CSV dialect, and the record shape of the search jobs."""

from __future__ import annotations

import dataclasses
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclasses.dataclass(frozen=True)
class Dialect:
    """How the fields of a record file are written."""

    # Defaults of the record files.
    directory: str = "data/"
    name: str = "passwords"
    ending: str = ".csv"
    has_header: bool = True
    charset: str = "UTF-8"
    separator: str = ";"
    quote: str = '"'
    escape: str = "\\"
    ignore_leading_whitespace: bool = True
    skip_differing_lines: bool = True
    multi_line: bool = False
    strict_quotes: bool = False

    @property
    def path(self) -> str:
        slash = "" if self.directory.endswith("/") else "/"
        dot = "" if self.ending.startswith(".") or not self.ending else "."
        return f"{self.directory}{slash}{self.name}{dot}{self.ending}"

    def options(self) -> dict:
        """Reader options.

        An unquoted empty field is null and ``""`` is the empty text; the null
        marker below cannot occur in a text file and keeps the two apart.
        """
        return {
            "sep": self.separator,
            "quote": self.quote,
            "escape": self.escape,
            "encoding": self.charset,
            "header": self.has_header,
            "enforceSchema": True,
            "ignoreLeadingWhiteSpace": self.ignore_leading_whitespace,
            "nullValue": "\u0000",
            "mode": "DROPMALFORMED" if self.skip_differing_lines else "PERMISSIVE",
            "multiLine": self.multi_line,
            # With pruning a line of wrong length passes if few columns are read.
            "columnPruning": False,
        }


def record_schema(n_hints: int) -> T.StructType:
    """Positional schema: id, name, alphabet, length, hash of the value, hashes of the hints."""
    fields = [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("alphabet", T.StringType()),
        T.StructField("plen", T.IntegerType()),
        T.StructField("value_hash", T.StringType()),
    ]
    hints = [T.StructField(f"hint_{i}", T.StringType()) for i in range(1, n_hints + 1)]
    return T.StructType(fields + hints)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _typed(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields in their types, null where the text does not fit.

    Lines are read as text, so that only their length decides whether they are
    skipped, whichever columns a query asks for.
    """
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


# Stands before a letter in place of what a split must not see; itself written with a letter, too.
_MARK = "\u0001"

# No line of a record file is cut here; one that holds it all the same comes back whole as a malformed line.
_NO_SEPARATOR = "\u0001\u0002\u0001"


def strict_fields(line: Column, dialect: Dialect) -> Column:
    """The fields of a line as an array of texts: what is written between quotes, and nothing else.

    Text outside quotes is dropped, also beside a quoted part of the same field; several quoted parts are one
    text. A field without quotes is null, ``""`` is the empty text. An escaped or doubled quote inside quotes is a
    quote; the escape character before another sign stays. A line that ends inside quotes has no fields (null), as
    has a null line.
    """
    quote, escape = dialect.quote, "" if dialect.escape == dialect.quote else dialect.escape
    marks = [(_MARK, "m"), *([(escape * 2, "e"), (escape + quote, "q")] if escape else [])]
    text = line
    for sign, letter in marks:
        text = F.replace(text, F.lit(sign), F.lit(_MARK + letter))
    # Every other part lies inside quotes.
    parts = F.split(text, re.escape(quote), -1)
    n = F.size(parts)

    def shown(part: Column, i: Column) -> Column:
        borders = F.repeat(F.lit(_MARK + "s"), F.regexp_count(part, F.lit(re.escape(dialect.separator))).cast("int"))
        doubled = (part == "") & (i > 0) & (i < n - 1)
        return (
            F.when(i % 2 == 1, F.concat(F.lit(_MARK + "t"), part))
            .when(doubled, F.lit(_MARK + "q"))
            .otherwise(borders)
        )

    def plain(field: Column) -> Column:
        found = F.replace(field, F.lit(_MARK + "t"), F.lit(""))
        for sign, letter in [(quote, "q"), (escape, "e"), (_MARK, "m")]:
            found = F.replace(found, F.lit(_MARK + letter), F.lit(sign))
        return F.when(F.contains(field, F.lit(_MARK + "t")), found)

    fields = F.split(F.array_join(F.transform(parts, shown), ""), _MARK + "s", -1)
    return F.when(n % 2 == 1, F.transform(fields, plain))


def _strict_lines(reader, schema: T.StructType, path: str, dialect: Dialect) -> DataFrame:
    """The fields of all lines as texts; Spark reads the lines, their charset and the header."""
    if dialect.multi_line:
        raise ValueError("strict quotes take one record a line")
    options = dialect.options() | {
        "sep": _NO_SEPARATOR, "quote": "", "ignoreLeadingWhiteSpace": False, "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "whole",
    }
    lines = reader.schema("line string, whole string").options(**options).csv(path)
    fields = lines.select(strict_fields(F.coalesce("whole", "line"), dialect).alias("fields"))
    if dialect.skip_differing_lines:
        fields = fields.where(F.size("fields") == len(schema.fields))
    return fields.select(*[F.get("fields", F.lit(i)).alias(f.name) for i, f in enumerate(schema.fields)])


def _texts(reader, schema: T.StructType, path: str, dialect: Dialect) -> DataFrame:
    if dialect.strict_quotes:
        return _strict_lines(reader, schema, path, dialect)
    return reader.schema(_as_text(schema)).options(**dialect.options()).csv(path)


def read_records(
    spark: SparkSession,
    schema: T.StructType,
    path: str | None = None,
    dialect: Dialect = Dialect(),
) -> DataFrame:
    """Read a record file; lines of another length than the schema are skipped.

    With ``strict_quotes`` fields are what :func:`strict_fields` says; lines that end inside quotes are skipped with
    those of another length, or have null fields if such lines stay.
    """
    return _typed(_texts(spark.read, schema, path or dialect.path, dialect), schema)


def stream_records(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    files_per_batch: int = 1,
    dialect: Dialect = Dialect(),
) -> DataFrame:
    """Read record files as a stream in bounded batches."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _typed(_texts(reader, schema, path, dialect), schema)


def hint_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("hint_")]


def with_hint_array(df: DataFrame) -> DataFrame:
    """Gather the hint columns into one array; the shape the search jobs take."""
    hints = F.array(*hint_columns(df))
    return df.select("id", "alphabet", "plen", "value_hash", hints.alias("hints"))
