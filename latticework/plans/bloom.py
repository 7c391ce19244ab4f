"""Registered queries: one-hash filters as approximate joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from latticework.operators import bloom as ops
from latticework.operators.bitset import pack
from latticework.plans.inputs import SETS_SQL, order_line_sets, table
from latticework.session import scratch_dir
from latticework.streaming.seen import Seen

# Runs of the stream of events.
RUNS = 3

# Smaller than the range of customer keys, so that keys do collide.
SIZE = 1_024


def _users(spark, sf_dir):
    return ops.build(table(spark, sf_dir, "events"), "user_id", SIZE)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")


def bloom_build(spark, sf_dir):
    """Filter per market segment over the customer keys."""
    words = ops.build(table(spark, sf_dir, "customer"), "c_custkey", SIZE, by="c_mktsegment")
    return ops.buckets(words)


def bloom_merge(spark, sf_dir):
    """The filters of all segments and of the event users merged into one."""
    segments = ops.build(table(spark, sf_dir, "customer"), "c_custkey", SIZE, by="c_mktsegment")
    return ops.buckets(ops.merge(segments, _users(spark, sf_dir)))


def _sized_users(spark, sf_dir):
    """A filter of the event users that is sized for them, so that it tells keys apart at any scale."""
    events = table(spark, sf_dir, "events")
    size = ops.size_for(events, "user_id")
    return ops.build(events, "user_id", size), size


def bloom_semi_join(spark, sf_dir):
    return ops.semi_join(_orders(spark, sf_dir), "o_custkey", *_sized_users(spark, sf_dir))


def bloom_anti_join(spark, sf_dir):
    return ops.anti_join(_orders(spark, sf_dir), "o_custkey", *_sized_users(spark, sf_dir))


def bloom_prefilter_join(spark, sf_dir):
    """Orders with the number of events of their customer."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    joined = ops.prefilter_join(_orders(spark, sf_dir), "o_custkey", users, "user_id", SIZE)
    return joined.select("o_orderkey", "user_id", "n_events")


def bloom_first_seen(spark, sf_dir):
    """For each event whether its user fell into a free bucket."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return ops.added_flags(events, "user_id", "event_id", SIZE)


def stream_first_seen(spark, sf_dir):
    """As ``bloom_first_seen``, over events that arrive in several runs; the filter is stored between these."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    ends = events.agg(F.min("event_id").alias("least"), F.max("event_id").alias("most")).first()
    path, seen = scratch_dir(spark, "events"), Seen.fresh(spark, "user_id", "event_id", SIZE)
    part = F.floor((F.col("event_id") - ends["least"]) * RUNS / (ends["most"] - ends["least"] + 1))
    for run in range(RUNS):
        events.where(part == run).write.mode("append").parquet(path)
        flags = seen.run_available(spark.readStream.schema(events.schema).parquet(path))
    return flags


def bloom_set_buckets(spark, sf_dir):
    """Bucket of each order, with its set of line numbers as the element."""
    return ops.set_buckets(pack(order_line_sets(spark, sf_dir)), SIZE)


def _returned(spark, sf_dir):
    """Filter whose elements are the sets of returned line numbers of the orders."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    sets = lines.select(F.col("l_orderkey").alias("set_id"), F.col("l_linenumber").cast("bigint").alias("bit"))
    return ops.build_of_sets(pack(sets), SIZE)


def bloom_semi_join_sets(spark, sf_dir):
    """Orders whose whole set of line numbers may be a set of returned ones."""
    return ops.semi_join_sets(pack(order_line_sets(spark, sf_dir)), _returned(spark, sf_dir), SIZE)


def bloom_anti_join_sets(spark, sf_dir):
    return ops.anti_join_sets(pack(order_line_sets(spark, sf_dir)), _returned(spark, sf_dir), SIZE)


def bloom_first_seen_sets(spark, sf_dir):
    """For each order whether its set of line numbers is the first in its bucket."""
    return ops.added_sets(pack(order_line_sets(spark, sf_dir)), SIZE)


QUERIES = {
    "bloom_build": bloom_build,
    "bloom_merge": bloom_merge,
    "bloom_semi_join": bloom_semi_join,
    "bloom_anti_join": bloom_anti_join,
    "bloom_prefilter_join": bloom_prefilter_join,
    "bloom_first_seen": bloom_first_seen,
    "stream_first_seen": stream_first_seen,
    "bloom_set_buckets": bloom_set_buckets,
    "bloom_semi_join_sets": bloom_semi_join_sets,
    "bloom_anti_join_sets": bloom_anti_join_sets,
    "bloom_first_seen_sets": bloom_first_seen_sets,
}


def _bucket(key: str, size: object = SIZE) -> str:
    # For keys below 2^31 the fold of the hash to 32 bits changes nothing.
    return f"xor({key}, 1234) % {size}"


_SIZED_USERS = f"""WITH sized AS (SELECT greatest(64, CAST(pow(2, ceil(log2(16 * count(DISTINCT user_id)))) AS BIGINT)) AS size FROM events),
filter AS (SELECT DISTINCT {_bucket('user_id', 'size')} AS bucket FROM events, sized)"""


_SET_BUCKETS = f"""WITH {SETS_SQL},
sets AS (SELECT set_id, xor(sum(1 << bit)::BIGINT, 1234) % {SIZE} AS bucket FROM order_line_sets GROUP BY set_id),
filter AS (SELECT DISTINCT xor(sum(1 << l_linenumber)::BIGINT, 1234) % {SIZE} AS bucket
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_orderkey)"""

_FIRST_SEEN = f"""SELECT event_id, user_id, {_bucket('user_id')} AS bucket,
       row_number() OVER (PARTITION BY {_bucket('user_id')} ORDER BY event_id) = 1 AS added
FROM events"""

ORACLES = {
    "bloom_semi_join_sets": f"{_SET_BUCKETS} SELECT set_id FROM sets WHERE bucket IN (SELECT bucket FROM filter)",
    "bloom_anti_join_sets": f"{_SET_BUCKETS} SELECT set_id FROM sets WHERE bucket NOT IN (SELECT bucket FROM filter)",
    "bloom_first_seen_sets": f"""{_SET_BUCKETS}
SELECT set_id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY set_id) = 1 AS added FROM sets""",
    "bloom_build": f"SELECT DISTINCT c_mktsegment AS set_id, {_bucket('c_custkey')} AS bucket FROM customer",
    "bloom_merge": f"""SELECT {_bucket('c_custkey')} AS bucket FROM customer
UNION SELECT {_bucket('user_id')} FROM events""",
    "bloom_semi_join": f"""{_SIZED_USERS}
SELECT o_orderkey, o_custkey FROM orders, sized
WHERE {_bucket('o_custkey', 'size')} IN (SELECT bucket FROM filter)""",
    "bloom_anti_join": f"""{_SIZED_USERS}
SELECT o_orderkey, o_custkey FROM orders, sized
WHERE {_bucket('o_custkey', 'size')} NOT IN (SELECT bucket FROM filter)""",
    "bloom_prefilter_join": """SELECT o_orderkey, user_id, n_events
FROM orders JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) ON o_custkey = user_id""",
    "bloom_first_seen": _FIRST_SEEN,
    "stream_first_seen": _FIRST_SEEN,
    "bloom_set_buckets": f"""WITH {SETS_SQL}
SELECT set_id, xor(sum(1 << bit)::BIGINT, 1234) % {SIZE} AS bucket FROM order_line_sets GROUP BY set_id""",
}
