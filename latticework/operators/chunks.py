"""Large values cut into numbered chunks, and put together again.

Chunk shape: ``(msg_id, n_chunks int, key int, chunk)``; keys count from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.functions.arrays import each
from latticework.operators.joins import lookup
from latticework.operators.placing import begun
from latticework.session import materialize

# Fixed value: default chunk size in bytes.
DEFAULT_CHUNK_SIZE = 260_001

_CHUNKS_PER_PART = 64


def chunk_count(length: Column, chunk_size: int) -> Column:
    """Number of chunks; an empty value still has one (empty) chunk."""
    padded = length.cast("bigint") + F.lit(chunk_size - 1)
    return F.greatest(F.call_function("div", padded, F.lit(chunk_size)), F.lit(1)).cast("int")


def split(
    df: DataFrame,
    msg_id: str,
    value: str,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    unit: str = "bytes",
) -> DataFrame:
    """Cut column ``value`` into chunks of ``chunk_size`` bytes or characters.

    In bytes a text is cut as its UTF-8 form and the chunks are binary; in characters
    the chunks are text. Null values have no chunk. Chunk numbers are exploded
    first and each chunk is cut from the value row by row, so the chunks of one
    value are never held together.
    """
    if unit not in ("bytes", "chars"):
        raise ValueError(f"unit must be 'bytes' or 'chars', not {unit!r}")
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    payload = F.col(value).cast("binary" if unit == "bytes" else "string")
    rows = (
        df.where(F.col(value).isNotNull())
        .select(F.col(msg_id).alias("msg_id"), payload.alias("part"))
        .select("*", chunk_count(F.length("part"), chunk_size).alias("n_chunks"))
        .select("*", F.lit(0).alias("before"), F.col("n_chunks").alias("n_here"))
    )
    if unit == "chars":
        # A position in a text is found by counting from its start, so long texts are cut
        # into parts of many chunks first.
        part_chars = _CHUNKS_PER_PART * chunk_size
        last_part = F.call_function("div", F.col("n_chunks") - 1, F.lit(_CHUNKS_PER_PART))
        rows = rows.select("*", each(F.sequence(F.lit(0), last_part.cast("int"))).alias("part_no"))
        done = F.col("part_no") * F.lit(_CHUNKS_PER_PART)
        rows = rows.select(
            "msg_id",
            "n_chunks",
            F.substring(F.col("part"), F.col("part_no") * F.lit(part_chars) + 1, F.lit(part_chars)).alias("part"),
            done.alias("before"),
            F.least(F.col("n_chunks") - done, F.lit(_CHUNKS_PER_PART)).alias("n_here"),
        )
    rows = rows.select("*", each(F.sequence(F.lit(1), F.col("n_here"))).alias("nr"))
    start = (F.col("nr") - F.lit(1)) * F.lit(chunk_size) + F.lit(1)
    return rows.select(
        "msg_id",
        "n_chunks",
        (F.col("before") + F.col("nr")).alias("key"),
        F.substring(F.col("part"), start, F.lit(chunk_size)).alias("chunk"),
    )


def joined_value(chunks: Column, binary: bool) -> Column:
    """Concatenate an array of ``(key, chunk)`` in key order."""
    parts = F.sort_array(chunks)["chunk"]
    if not binary:
        return F.array_join(parts, "")
    # A cast between binary and text keeps all bytes as they are.
    return F.array_join(parts.cast("array<string>"), "").cast("binary")


def is_binary(chunks: DataFrame) -> bool:
    return isinstance(chunks.schema["chunk"].dataType, T.BinaryType)


def _by_key(chunks: DataFrame) -> DataFrame:
    """One row a key; replays are reduced on the map side."""
    return (
        chunks.where(F.col("key").isNotNull())
        .groupBy("msg_id", "n_chunks", "key")
        .agg(F.min("chunk").alias("chunk"), F.max("chunk").alias("other"))
    )


def reassemble(chunks: DataFrame, as_text: bool = False) -> DataFrame:
    """``(msg_id, n_chunks, n_seen, value)`` per message; ``n_seen`` counts distinct keys.

    A message is complete if its keys are exactly 1 to ``n_chunks`` and no key has two contents;
    else ``value`` is null. Repeated chunks count once, and replays, however many, are reduced by their key, in each task
    first, before a message is gathered. The distinct chunks of a message meet in one task, as the result is one cell.
    """
    binary = is_binary(chunks)
    value = joined_value(F.col("parts"), binary)
    if binary and as_text:
        value = value.cast("string")
    by_key = _by_key(chunks)
    n = F.col("n_chunks")
    complete = (F.col("n_seen") == n) & (F.col("first") == 1) & (F.col("last") == n) & F.col("agreed")
    return (
        by_key.groupBy("msg_id", "n_chunks")
        .agg(
            F.collect_list(F.struct("key", "chunk")).alias("parts"),
            F.count("*").cast("int").alias("n_seen"),
            F.min("key").alias("first"),
            F.max("key").alias("last"),
            F.bool_and(F.coalesce(F.col("chunk") == F.col("other"), F.lit(False))).alias("agreed"),
        )
        .select("msg_id", "n_chunks", "n_seen", F.when(complete, value).alias("value"))
    )


def segments(chunks: DataFrame, chunks_per_segment: int = _CHUNKS_PER_PART) -> DataFrame:
    """``(msg_id, n_chunks, segment, start, size, part)``: the value of each complete message in ordered segments.

    For values that are larger than a cell. A segment holds ``chunks_per_segment`` chunks (the last one fewer) and the
    parts of a message in the order of ``segment``, from 0, are the value that :func:`reassemble` gives; ``start`` is the
    number of bytes (binary chunks) or characters (text) before a part and ``size`` its own. A segment is gathered alone and
    messages are judged from counts of their segments, so no task holds a value. Messages that are not complete, for the reasons of
    :func:`reassemble`, have no segment; an empty value has one, of size 0. No rows: no rows.
    """
    if chunks_per_segment < 1:
        raise ValueError("chunks_per_segment must be at least 1")
    # A struct, as null parts of it are equal.
    message = F.struct("msg_id", "n_chunks").alias("message")
    segment = F.call_function("div", F.col("key").cast("long") - 1, F.lit(chunks_per_segment)).alias("segment")
    agreed = F.bool_and(F.coalesce(F.col("chunk") == F.col("other"), F.lit(False)))
    gathered = (
        _by_key(chunks)
        .groupBy(message, segment)
        .agg(
            F.collect_list(F.struct("key", "chunk")).alias("entries"),
            F.count("*").alias("n_seen"),
            F.min("key").alias("first"),
            F.max("key").alias("last"),
            agreed.alias("agreed"),
        )
        .withColumn("part", joined_value(F.col("entries"), is_binary(chunks)))
        .withColumn("size", F.length("part").cast("long"))
        .drop("entries")
    )
    # Read for the counts, the places and the parts.
    gathered = materialize(gathered, "segments")
    n = F.col("message.n_chunks")
    complete = (F.sum("n_seen") == F.first(n)) & (F.min("first") == 1) & (F.max("last") == F.first(n)) & F.bool_and("agreed")
    whole = gathered.groupBy("message").agg(complete.alias("complete")).where("complete").select("message")
    parts = lookup(gathered.select("message", "segment", "size"), whole, ["message"], "inner")
    placed = begun(parts, "message", "segment", "size", order_bits=32)
    found = lookup(gathered.select("message", "segment", "size", "part"), placed, ["message", "segment"], "inner")
    return found.select("message.*", "segment", F.col("begun").alias("start"), "size", "part")
