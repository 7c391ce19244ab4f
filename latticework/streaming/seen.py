"""First-seen flags over a stream, with a stored filter that lives between batches and runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from latticework.functions.hashing import DEFAULT_FILTER_BITS
from latticework.operators import bloom
from latticework.session import scratch_dir

_WORDS = "word_ix bigint, word bigint, size bigint"


@dataclass(frozen=True)
class Seen:
    """A filter of ``size`` bits below ``path``, to which the batches of streams are added one after another.

    Batch ``n`` reads the filter that batch ``n - 1`` left and writes its own beside it; a repeated batch reads and
    writes the same again, so its flags do not change. Two filters of ``size / 64`` rows at most are stored,
    however many batches there were. All runs over one ``path`` are one stream, continued at its checkpoint.
    """

    path: str
    key: str
    order: str
    size: int = DEFAULT_FILTER_BITS

    @classmethod
    def fresh(cls, spark: SparkSession, key: str, order: str, size: int = DEFAULT_FILTER_BITS) -> Seen:
        """An empty filter in the shared folder."""
        return cls(scratch_dir(spark, "seen"), key, order, size)

    def _stored(self, spark: SparkSession, number: int) -> DataFrame:
        """The filter after batch ``number``; before the first batch it is empty."""
        if number < 0:
            return spark.createDataFrame([], _WORDS)
        return spark.read.schema(_WORDS).parquet(f"{self.path}/filter-{number % 2}")

    def add(self, batch: DataFrame, number: int) -> None:
        """Write the flags of batch ``number`` (from 0, without gaps) and the filter after it.

        A row is added if its bucket was free before the batch and it is the first of the batch in it. Empty batches
        and null keys add nothing.
        """
        spark = batch.sparkSession
        before = self._stored(spark, number - 1)
        flags = bloom.added_flags(batch, self.key, self.order, self.size, before)
        written = f"{self.path}/flags/batch={number}"
        flags.write.mode("overwrite").parquet(written)
        # The filter follows from the written flags: the batch itself is read once.
        after = bloom.extended(before, spark.read.schema(flags.schema).parquet(written), self.size)
        after.write.mode("overwrite").parquet(f"{self.path}/filter-{number % 2}")

    def run_available(self, stream: DataFrame) -> DataFrame:
        """Add all available input of ``stream`` and return the flags of all batches so far.

        The rows of ``stream`` with ``bucket`` and ``added``; rows of earlier batches come first, those of a batch
        in the order of ``order``.
        """
        spark = stream.sparkSession
        query = (
            stream.writeStream.foreachBatch(self.add)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        empty = bloom.added_flags(spark.createDataFrame([], stream.schema), self.key, self.order, self.size)
        if self.batches(spark) == 0:
            return empty
        root = f"{self.path}/flags"
        return spark.read.schema(empty.schema).option("basePath", root).parquet(root).select(*empty.columns)

    def batches(self, spark: SparkSession) -> int:
        """Batches that were added."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/flags")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        return len(files.listStatus(folder)) if files.exists(folder) else 0

    def words(self, spark: SparkSession) -> DataFrame:
        """The filter as it is after the last batch, for joins."""
        return self._stored(spark, self.batches(spark) - 1)
