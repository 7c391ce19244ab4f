"""Token ids in Parquet: list columns in chosen encodings, small row groups, page indexes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latticework.llm.text import as_bytes, smaller_batches
from latticework.llm.tokens import encoder
from latticework.session import BROADCAST_ROWS

FIELDS = "doc_id long, shard int, start_in_shard long, n_tokens long, tokens array<int>"
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2_000
ENCODINGS = ("dictionary", "delta")


def _encode(tokenizer: str, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, at = encoder(tokenizer).encode_all, TaskContext.get().partitionId(), 0
        for batch in smaller_batches(batches, "text", 4 << 20):
            ids = [found + end for found in encode(as_bytes(batch.column("text")))]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            ends = np.cumsum(sizes)
            values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.full(len(ids), shard), pa.int32()),
                    pa.array(at + ends - sizes),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values),
                ],
                [field.split()[0] for field in FIELDS.split(", ")],
            )
            at += int(ends[-1])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Writes the ids of each whole text and ``end_id`` as Parquet below ``path``, in ascending order of id.

    Files are shards of the order: (doc_id, shard, start_in_shard, n_tokens, tokens). Tokens are a list
    column, dictionary-encoded or, with ``encoding="delta"``, delta-packed; the other columns are
    delta-packed. Row groups and pages have the given sizes, and the pages of every column are
    indexed by their least and largest values, so that readers of some ids or of the metadata alone skip
    the rest.

    Rows without id come first; rows of one id, however many, are spread and ordered by a hash of their text, then by the text. A null or empty text is ``end_id``
    alone. Other columns are not read. No rows: files without rows.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding is one of {ENCODINGS}")
    ordered = (
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
        .withColumn("spread", F.xxhash64("text"))
        .repartitionByRange("id", "spread")
        .sortWithinPartitions("id", "spread", "text")
        .drop("spread")
    )
    options = {
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.dictionary.page.size": 4 << 20,
    }
    ordered.mapInArrow(_encode(tokenizer, end_id), FIELDS).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None, tokens: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) of what ``write_tokens`` wrote; ``start`` counts the ids of all
    documents before. ``where`` reads some documents only, ``tokens=False`` the metadata alone.
    """
    files = spark.read.schema(FIELDS).parquet(path)
    # One row a shard; a running sum over the shards gives where each begins.
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("in_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begun = shards.select("shard", F.coalesce(F.sum("in_shard").over(before), F.lit(0)).alias("begun"))
    # Shards are numbered from 0, so their number is known before the join; else tokens would be shuffled.
    if (shards.agg(F.max("shard")).first()[0] or 0) < BROADCAST_ROWS:
        begun = F.broadcast(begun)
    if where is not None:
        files = files.where(where)
    found = files.join(begun, "shard").withColumn("start", F.col("begun") + F.col("start_in_shard"))
    return found.select("doc_id", "start", "n_tokens", *["tokens"] * tokens)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("tokens")
        values, borders = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
        sums = [zlib.crc32(values[a:b]) for a, b in zip(borders[:-1], borders[1:])]
        columns = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names)


def checksums(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows of ``read_tokens``: the CRC-32 of the ids as
    little-endian unsigned 32-bit integers."""
    return documents.mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
