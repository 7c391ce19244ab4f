"""Streams of chunks: sources, and messages put together as their chunks arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.operators.chunks import is_binary, joined_value
from latticework.operators.joins import lookup


def write_chunks(chunks: DataFrame, path: str, sent_at: str) -> None:
    """Store chunks with the time their message was sent (``sent_at``, a timestamp text).

    Spread by content hash over as many files as the session shuffles to, so that chunks
    arrive out of order.
    """
    stamped = chunks.withColumn("sent_at", F.lit(sent_at).cast("timestamp"))
    stamped.repartition(F.xxhash64("msg_id", "key")).write.mode("append").parquet(path)


def write_end_mark(spark: SparkSession, schema: T.StructType, path: str, at: str) -> None:
    """Append a row without a message at time ``at``; it moves the watermark past all
    messages before, so that a run over a finished input also emits the last ones."""
    mark = spark.range(1).select(
        *[
            (F.lit(at).cast("timestamp") if f.name == "sent_at" else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
    mark.write.mode("append").parquet(path)


def stream_chunks(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def stream_reassemble(chunks: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``(msg_id, n_chunks, n_seen, value)``: each message once, in append mode.

    ``chunks`` carries ``sent_at``, equal for all chunks of a message. A message is
    emitted when the watermark passes it; by then its chunks have had ``delay``
    to arrive in any order and any number of times. ``value`` is null for a message
    whose keys are not exactly 1 to ``n_chunks``, or of which a key has two contents, so a
    loss is reported, and its state ends.
    """
    value = joined_value(F.col("parts"), is_binary(chunks))
    keys = F.array_distinct(F.transform("parts", lambda p: p["key"]))
    n = F.col("n_chunks")
    complete = (
        (F.size("parts") == n) & (F.size(keys) == n) & (F.array_min(keys) == 1) & (F.array_max(keys) == n)
    )
    return (
        chunks.withWatermark("sent_at", delay)
        .groupBy("msg_id", "n_chunks", "sent_at")
        .agg(
            F.collect_set(F.struct("key", "chunk")).alias("parts"),
            F.count("key").alias("n_arrived"),
        )
        # Leaves out the end mark. On an aggregate, since a filter on the message
        # would be pushed below the watermark and hide the mark from it.
        .where(F.col("n_arrived") > 0)
        .select(
            "msg_id",
            "n_chunks",
            F.size(keys).alias("n_seen"),
            F.when(complete, value).alias("value"),
        )
    )


class Assembly:
    """Messages that are handed on as soon as they are complete, with an account of every chunk.

    The state is tables below ``path``, a folder for each batch, which a repeated batch writes anew, so it
    outlives executors and runs. A batch reads the state of the batch before and writes:

    * ``messages`` (msg_id, n_chunks, n_seen, value): complete messages, in the batch that completes them, and
      those whose time has passed, with a null value;
    * ``open``: the chunks of messages that are not complete, each key once;
    * ``ended`` (msg_id, sent_at): messages that were handed on, as long as chunks of them are not late;
    * ``account`` (n_in, n_used, n_repeated, n_stray, n_late): where the chunks of the batch went.

    A chunk is late if it was sent more than ``delay`` seconds before the latest of the earlier batches; a
    message that is open by then ends, incomplete. A chunk is stray if its key is null or not from 1 to ``n_chunks``. It is
    repeated if its key was seen before or its message has ended: the first content of a key that arrives
    counts, the least one inside a batch. Others are used. A chunk without message id or time is stray.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, delay: int = 3600):
        self.spark, self.path, self.delay = spark, path.rstrip("/"), delay
        self.chunk = schema["chunk"].dataType
        kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
        base = f"msg_id {kinds['msg_id']}, n_chunks int"
        self.fields = {
            "messages": f"{base}, n_seen int, value {kinds['chunk']}",
            "open": f"{base}, sent_at timestamp, key int, chunk {kinds['chunk']}",
            "ended": f"{base}, sent_at timestamp",
            "account": "n_in bigint, n_used bigint, n_repeated bigint, n_stray bigint, n_late bigint, latest timestamp",
        }

    def table(self, name: str, batch: int | None = None) -> DataFrame:
        """A table of one batch, or of all batches; empty before the first."""
        if batch is not None and batch < 0 or not self._exists(f"{self.path}/{name}"):
            return self.spark.createDataFrame([], self.fields[name])
        path = f"{self.path}/{name}" if batch is None else f"{self.path}/{name}/batch={batch}"
        names = self.spark.createDataFrame([], self.fields[name]).columns
        return self.spark.read.schema(self.fields[name]).option("basePath", path).parquet(path).select(*names)

    def _exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _store(self, name: str, batch: int, rows: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def add(self, chunks: DataFrame, batch: int) -> None:
        """One batch of chunks; batches are numbered from 0."""
        key = ["msg_id", "n_chunks", "sent_at"]
        known, ended = self.table("open", batch - 1), self.table("ended", batch - 1)
        latest = self.table("account", batch - 1).agg(F.max("latest")).first()[0]
        border = F.lit(latest) - F.expr(f"INTERVAL {self.delay} SECONDS")
        stray = ~F.coalesce(F.col("key").between(1, F.col("n_chunks")), F.lit(False))
        stray |= F.col("msg_id").isNull() | F.col("sent_at").isNull()
        late = F.coalesce(F.col("sent_at") < border, F.lit(False)) if latest is not None else F.lit(False)
        kind = F.when(stray, F.lit("stray")).when(late, F.lit("late")).otherwise(F.lit("new"))
        arrived = self._store("arrived", batch, chunks.select(*key, "key", "chunk", kind.alias("kind")))
        # Replays of a key are reduced before anything is gathered.
        new = arrived.where("kind = 'new'").groupBy(*key, "key").agg(F.min("chunk").alias("chunk"))
        new = new.join(known.select(*key, "key"), [*key, "key"], "left_anti")
        new = self._store("used", batch, lookup(new, ended, key, "left_anti"))
        every = known.select(*key, "key", "chunk").unionByName(new.select(*key, "key", "chunk"))
        counts = every.groupBy(*key).agg(F.count("*").cast("int").alias("n_seen"))
        counts = counts.withColumn("complete", F.col("n_seen") == F.col("n_chunks"))
        times = [t for t in (latest, arrived.where("kind != 'stray'").agg(F.max("sent_at")).first()[0]) if t is not None]
        latest = max(times, default=None)
        past = F.lit(False)
        if latest is not None:
            past = F.col("sent_at") < F.lit(latest) - F.expr(f"INTERVAL {self.delay} SECONDS")
        counts = self._store("counts", batch, counts.withColumn("done", F.col("complete") | past))
        done = lookup(every, counts.where("done"), key, "inner")
        value = joined_value(F.collect_list(F.struct("key", "chunk")), isinstance(self.chunk, T.BinaryType))
        messages = done.groupBy(*key, "n_seen", "complete").agg(value.alias("value"))
        value = F.when(F.col("complete"), F.col("value")).alias("value")
        self._store("messages", batch, messages.select("msg_id", "n_chunks", "n_seen", value))
        self._store("open", batch, lookup(every, counts.where("done").select(*key), key, "left_anti").select(*key, "key", "chunk"))
        # Chunks of messages of passed times are late, so these need not be known.
        gone = ended.unionByName(counts.where("done").select("msg_id", "n_chunks", "sent_at")).where(~past)
        self._store("ended", batch, gone.select("msg_id", "n_chunks", "sent_at").distinct())
        kinds = arrived.agg(
            F.count("*").alias("n_in"), F.count_if(F.col("kind") == "stray").alias("n_stray"),
            F.count_if(F.col("kind") == "late").alias("n_late"),
        )
        n_used = new.count()
        account = kinds.select(
            "n_in", F.lit(n_used).cast("bigint").alias("n_used"),
            (F.col("n_in") - n_used - F.col("n_stray") - F.col("n_late")).alias("n_repeated"), "n_stray", "n_late",
            F.lit(latest).cast("timestamp").alias("latest"),
        )
        self._store("account", batch, account)

    def run(self, stream: DataFrame) -> None:
        """Adds all available input of a stream; a later run goes on where this one ends."""
        query = (
            stream.writeStream.foreachBatch(self.add)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def messages(self) -> DataFrame:
        """The messages handed on so far."""
        return self.table("messages")

    def account(self) -> DataFrame:
        """One row: how many chunks came in, and where they went."""
        counts = ("n_in", "n_used", "n_repeated", "n_stray", "n_late")
        return self.table("account").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts))
