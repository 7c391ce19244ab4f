"""Running a stream over what is available and reading its output back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from latticework.session import scratch_dir


def run_available(stream: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Process all available input into Parquet files and return them as a table.

    The sink is append-only with a checkpoint in the shared folder, so a restarted
    run writes each row once.
    """
    spark = stream.sparkSession
    path = path or scratch_dir(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", scratch_dir(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, label: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a batch job to each bounded batch of all available input and return the results as a table.

    Each batch has a folder of its own, which a repeated batch writes anew, so a restarted run
    holds each row once.
    """
    spark = stream.sparkSession
    path = scratch_dir(spark, label)
    empty = transform(spark.createDataFrame([], stream.schema))

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", scratch_dir(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.lastProgress is None:
        return empty
    return spark.read.schema(empty.schema).option("basePath", path).parquet(path).select(*empty.columns)
