import contextlib

import pytest
from pyspark.sql import functions as F

from latticework.operators import bitset, bloom
from latticework.operators.joins import lookup


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a few megabytes count as skew."""
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        yield


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, n=200_000):
    """A third of all rows carries one key."""
    return spark.range(0, n, 1, 8).selectExpr("if(id % 3 = 0, 7, id % 5000) as k", "id")


def aggregated(spark):
    """A table that is already partitioned by its key."""
    return spark.range(50_000).selectExpr("id % 5000 as k").groupBy("k").agg(F.max("k").alias("v"))


def test_hot_key_is_split_even_if_the_table_was_aggregated(spark, small_partitions):
    table = aggregated(spark)
    joined = lookup(hot_rows(spark), table, ["k"])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 200_000 and joined.where("k <> v").count() == 0


def test_plain_join_with_an_aggregate_is_not_split(spark, small_partitions):
    table = aggregated(spark)
    assert "skew=true" not in final_plan(hot_rows(spark).join(table, "k", "left"))


def test_operators_split_their_hot_keys(spark, small_partitions, monkeypatch):
    words = bitset.pack(spark.range(0, 10_000, 2).selectExpr("1 as set_id", "id as bit"))
    probes = hot_rows(spark).selectExpr("1 as set_id", "k as bit", "id")
    got = bitset.get(words, probes)
    assert "skew=true" in final_plan(got)
    assert got.where("is_set <> (bit % 2 = 0)").count() == 0 and got.count() == 200_000
    monkeypatch.setattr(bloom, "BROADCAST_BUCKETS", 0)
    flags = bloom.added_flags(hot_rows(spark), "k", "id", 100_003)
    assert "skew=true" in final_plan(flags)
    assert flags.where("added").count() == 5_000
