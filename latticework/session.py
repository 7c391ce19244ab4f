"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A build side is broadcast only while it provably stays below this many rows.
BROADCAST_ROWS = 1_000_000


def build_session(app: str = "latticework", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder of the machine.
    Nothing below is removed here; :func:`drop_scratch` removes a path once its readers are done.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="latticework-")
    return f"{root.rstrip('/')}/latticework/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back; ``options`` go to the writer.

    The result has real size statistics and survives the loss of executors.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Spark's limit to the buckets of a table.
_MOST_BUCKETS = 100_000


def materialize_buckets(df: DataFrame, label: str, keys: list[str], n_buckets: int) -> DataFrame:
    """Write ``df`` once to the scratch folder, bucketed by ``keys``, and read it back.

    Joins on just these keys leave the result where it lies and shuffle the other side to its buckets. Only while
    it is written the table has an entry in the catalog; its files stay.
    """
    spark = df.sparkSession
    n_buckets = min(n_buckets, _MOST_BUCKETS)
    name = f"spark_catalog.default.latticework_{uuid.uuid4().hex}"
    path = scratch_dir(spark, label)
    rows = df.repartition(n_buckets, *keys)
    try:
        rows.write.format("parquet").bucketBy(n_buckets, *keys).option("path", path).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a stored table below the scratch folder; other paths are refused."""
    if "/latticework/" not in path:
        raise ValueError(f"{path} is not below a scratch folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
