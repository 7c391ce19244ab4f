"""Registered queries: chunked values."""

from __future__ import annotations

from pyspark.sql import functions as F

from latticework.operators import chunks as ops
from latticework.plans.inputs import table
from latticework.session import scratch_dir
from latticework.streaming import chunks as streams
from latticework.streaming.runs import run_available

CHUNK = 1_000
PER_SEGMENT = 2

# Send time of the streamed messages, and a time past the watermark delay.
SENT_AT = "2024-01-01 00:00:00"
END_AT = "2024-01-01 02:00:00"
# A day after the streamed messages.
LATER = "2024-01-02 00:00:00"


def _split(spark, sf_dir, unit="chars"):
    return ops.split(table(spark, sf_dir, "documents"), "doc_id", "text", CHUNK, unit)


def chunk_split(spark, sf_dir):
    return _split(spark, sf_dir)


def chunk_split_bytes(spark, sf_dir):
    """Whole web pages cut by bytes, with the size and digest of each chunk."""
    parts = ops.split(table(spark, sf_dir, "pages"), "page_id", "html", CHUNK, "bytes")
    return parts.select(
        "msg_id", "n_chunks", "key", F.length("chunk").alias("n_bytes"), F.hex("chunk").alias("chunk")
    )


def _damaged(parts):
    """All chunks, and what goes wrong with them: each first chunk comes twice; messages of every
    fifth number lose their last chunk, of every seventh repeat it with another content, and of every
    eleventh have one chunk too many."""
    last = parts.where("key = n_chunks")
    kept = parts.where("msg_id % 5 != 4 OR key < n_chunks")
    other = last.where("msg_id % 7 = 3").withColumn("chunk", F.concat("chunk", F.lit("?")))
    more = last.where("msg_id % 11 = 5").withColumn("key", F.col("key") + 1)
    return kept.unionByName(parts.where("key = 1 AND n_chunks > 1")).unionByName(other).unionByName(more)


def chunk_reassemble(spark, sf_dir):
    parts = _damaged(_split(spark, sf_dir))
    whole = ops.reassemble(parts.repartition(F.xxhash64("msg_id", "key")))
    return whole.select(F.col("msg_id").alias("doc_id"), "n_seen", F.col("value").alias("text"))


def chunk_reassemble_bytes(spark, sf_dir):
    parts = ops.split(table(spark, sf_dir, "pages"), "page_id", "html", CHUNK, "bytes")
    whole = ops.reassemble(parts, as_text=True)
    return whole.select(F.col("msg_id").alias("page_id"), F.col("value").alias("html"))


def chunk_segments(spark, sf_dir):
    """The complete messages of ``chunk_reassemble`` in segments of two chunks."""
    parts = _damaged(_split(spark, sf_dir))
    found = ops.segments(parts.repartition(F.xxhash64("msg_id", "key")), PER_SEGMENT)
    return found.select(F.col("msg_id").alias("doc_id"), "segment", "start", "size", F.col("part").alias("text"))


def stream_reassemble(spark, sf_dir):
    path = scratch_dir(spark, "chunk-files")
    streams.write_chunks(_damaged(_split(spark, sf_dir)), path, SENT_AT)
    schema = spark.read.parquet(path).schema
    streams.write_end_mark(spark, schema, path, END_AT)
    parts = streams.stream_chunks(spark, path, schema, files_per_batch=2)
    whole = run_available(streams.stream_reassemble(parts), "reassembled")
    return whole.select(F.col("msg_id").alias("doc_id"), "n_seen", F.col("value").alias("text"))


def _assembled(spark, sf_dir):
    """Messages in three deliveries: first all but some last chunks, with each first chunk twice; then, within the
    delay, the last chunks of two messages of five and whole messages again; and a day later one more
    chunk, which ends the open messages, and what was missing, too late."""
    path = scratch_dir(spark, "assembly-files")
    parts = _split(spark, sf_dir)
    schema = parts.withColumn("sent_at", F.lit(SENT_AT).cast("timestamp")).schema
    assembly = streams.Assembly(spark, scratch_dir(spark, "assembly"), schema)
    late = "msg_id % 5 IN (1, 3, 4) AND key = n_chunks"
    again = parts.where("msg_id % 5 IN (1, 3) AND key = n_chunks").unionByName(parts.where("msg_id % 10 = 0"))
    mark = parts.where("msg_id % 5 = 4 AND key = n_chunks").limit(0).unionByName(
        spark.sql("SELECT -1L AS msg_id, 1 AS n_chunks, 1 AS key, 'later' AS chunk")
    )
    first = parts.where(f"NOT ({late})").unionByName(parts.where("key = 1 AND n_chunks > 1"))
    lost = parts.where("msg_id % 5 = 4 AND key = n_chunks")
    for rows, sent_at in ((first, SENT_AT), (again, SENT_AT), (mark, LATER), (lost, SENT_AT)):
        streams.write_chunks(rows, path, sent_at)
        assembly.run(streams.stream_chunks(spark, path, schema, files_per_batch=8))
    return assembly


def stream_messages(spark, sf_dir):
    """Each message once, in the batch that completes it or ends its time."""
    messages = _assembled(spark, sf_dir).messages()
    return messages.select(F.col("msg_id").alias("doc_id"), "n_seen", F.col("value").alias("text"))


def stream_chunk_account(spark, sf_dir):
    """Chunks that came in, and how many were used, repeated, stray and late."""
    return _assembled(spark, sf_dir).account()


QUERIES = {
    "stream_messages": stream_messages,
    "stream_chunk_account": stream_chunk_account,
    "chunk_split": chunk_split,
    "chunk_split_bytes": chunk_split_bytes,
    "chunk_reassemble": chunk_reassemble,
    "chunk_reassemble_bytes": chunk_reassemble_bytes,
    "chunk_segments": chunk_segments,
    "stream_reassemble": stream_reassemble,
}

# Messages that lost their only chunk never arrive, unless another chunk of them did.
_DOCUMENTS = f"""SELECT doc_id,
  CAST(n - (CASE WHEN doc_id % 5 = 4 AND doc_id % 7 <> 3 THEN 1 ELSE 0 END)
    + (CASE WHEN doc_id % 11 = 5 THEN 1 ELSE 0 END) AS INTEGER) AS n_seen,
  CASE WHEN doc_id % 11 = 5 OR (doc_id % 7 = 3 AND doc_id % 5 <> 4) OR (doc_id % 5 = 4 AND doc_id % 7 <> 3) THEN NULL
    WHEN doc_id % 5 = 4 THEN text || '?' ELSE text END AS text
FROM (SELECT doc_id, text, greatest(1, (length(text) + {CHUNK - 1}) // {CHUNK}) AS n FROM documents)
WHERE n > 1 OR doc_id % 5 <> 4 OR doc_id % 7 = 3 OR doc_id % 11 = 5"""

_SIZES = f"""SELECT doc_id, text, greatest(1, (length(text) + {CHUNK - 1}) // {CHUNK}) AS n FROM documents"""

ORACLES = {
    # Messages that lost their only chunk never arrive in time.
    "stream_messages": f"""SELECT doc_id, CAST(CASE WHEN doc_id % 5 = 4 THEN n - 1 ELSE n END AS INTEGER) AS n_seen,
  CASE WHEN doc_id % 5 <> 4 THEN text END AS text
FROM ({_SIZES}) WHERE doc_id % 5 <> 4 OR n > 1
UNION ALL SELECT -1, 1, 'later'""",
    "stream_chunk_account": f"""WITH sizes AS ({_SIZES}), counts AS (
  SELECT sum(n) AS parts, count(*) FILTER (n > 1) AS firsts, count(*) FILTER (doc_id % 5 = 4) AS lost,
    coalesce(sum(n) FILTER (doc_id % 10 = 0), 0) AS again FROM sizes)
SELECT CAST(parts + firsts + again + 1 AS BIGINT) AS n_in, CAST(parts - lost + 1 AS BIGINT) AS n_used,
  CAST(firsts + again AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_stray, CAST(lost AS BIGINT) AS n_late
FROM counts""",
    "chunk_split": f"""SELECT msg_id, n_chunks, CAST(k AS INTEGER) AS key,
       substring(text, (k - 1) * {CHUNK} + 1, {CHUNK}) AS chunk
FROM (SELECT doc_id AS msg_id, text,
             CAST(greatest(1, (length(text) + {CHUNK - 1}) // {CHUNK}) AS INTEGER) AS n_chunks FROM documents),
     unnest(range(1, n_chunks + 1)) AS u(k)""",
    "chunk_split_bytes": f"""SELECT msg_id, n_chunks, CAST(k AS INTEGER) AS key,
       CAST(least({CHUNK}, n - (k - 1) * {CHUNK}) AS INTEGER) AS n_bytes,
       substring(hexed, (k - 1) * {2 * CHUNK} + 1, {2 * CHUNK}) AS chunk
FROM (SELECT page_id AS msg_id, hex(encode(html)) AS hexed, strlen(html) AS n,
             CAST(greatest(1, (strlen(html) + {CHUNK - 1}) // {CHUNK}) AS INTEGER) AS n_chunks FROM pages),
     unnest(range(1, n_chunks + 1)) AS u(k)""",
    "chunk_reassemble": _DOCUMENTS,
    "chunk_segments": f"""WITH whole AS (
  SELECT doc_id, text, doc_id % 5 = 4 AS marked, (n + {PER_SEGMENT - 1}) // {PER_SEGMENT} AS n_segments FROM ({_SIZES})
  WHERE text IS NOT NULL AND doc_id % 11 <> 5 AND (doc_id % 7 = 3) = (doc_id % 5 = 4)
), parts AS (
  SELECT doc_id, k, substring(text, k * {PER_SEGMENT * CHUNK} + 1, {PER_SEGMENT * CHUNK})
    || CASE WHEN marked AND k = n_segments - 1 THEN '?' ELSE '' END AS part
  FROM whole, unnest(range(0, n_segments)) AS u(k))
SELECT doc_id, CAST(k AS BIGINT) AS segment, CAST(k * {PER_SEGMENT * CHUNK} AS BIGINT) AS start,
  CAST(length(part) AS BIGINT) AS size, part AS text FROM parts""",
    "chunk_reassemble_bytes": "SELECT page_id, html FROM pages",
    "stream_reassemble": _DOCUMENTS,
}
