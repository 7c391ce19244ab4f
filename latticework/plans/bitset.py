"""Registered queries: sets of integers stored as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from latticework.operators import bitset as ops
from latticework.operators import navigation as nav
from latticework.plans.inputs import SETS_SQL, line_sets, order_line_sets, priority_sets, table

WORDS_PER_SEGMENT = 16


def _a(spark, sf_dir):
    return ops.pack(line_sets(spark, sf_dir))


def _b(spark, sf_dir):
    return ops.pack(priority_sets(spark, sf_dir))


def _all_sets(spark, sf_dir):
    """Line numbers, and the key of every nation: most of these sets are empty."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("set_id"))
    return nations.unionByName(line_sets(spark, sf_dir).select("set_id"))


def _probes(spark, sf_dir):
    """Each order asks in the set of its priority number."""
    return priority_sets(spark, sf_dir).withColumnRenamed("bit", "from_bit")


def bitset_build(spark, sf_dir):
    return ops.unpack(_a(spark, sf_dir))


def bitset_cardinality(spark, sf_dir):
    return ops.cardinality(_a(spark, sf_dir), _all_sets(spark, sf_dir))


def bitset_length(spark, sf_dir):
    return ops.logical_length(_a(spark, sf_dir), _all_sets(spark, sf_dir))


def bitset_get(spark, sf_dir):
    return ops.get(_a(spark, sf_dir), priority_sets(spark, sf_dir))


def bitset_or(spark, sf_dir):
    return ops.unpack(ops.set_or(_a(spark, sf_dir), _b(spark, sf_dir)))


def bitset_and(spark, sf_dir):
    return ops.unpack(ops.set_and(_a(spark, sf_dir), _b(spark, sf_dir)))


def bitset_xor(spark, sf_dir):
    return ops.unpack(ops.set_xor(_a(spark, sf_dir), _b(spark, sf_dir)))


def bitset_andnot(spark, sf_dir):
    return ops.unpack(ops.set_andnot(_a(spark, sf_dir), _b(spark, sf_dir)))


def bitset_intersects(spark, sf_dir):
    return ops.intersects(_a(spark, sf_dir), _b(spark, sf_dir))


def bitset_set_range(spark, sf_dir):
    """Set per supplier: for each line a range of up to six orders (none for line 1)."""
    ranges = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("set_id"),
        F.col("l_orderkey").alias("from_bit"),
        (F.col("l_orderkey") + F.col("l_linenumber") - 1).alias("to_bit"),
    )
    keys = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("set_id"), F.col("s_suppkey").alias("bit")
    )
    return ops.unpack(ops.set_range(ops.pack(keys), ranges))


def bitset_update(spark, sf_dir):
    """Set per user: the hours of day with activity, as the events tell.

    A signup clears hours, an error resets the user, all else sets the hour.
    """
    events = table(spark, sf_dir, "events")
    hour = F.hour("ts").cast("bigint")
    updates = events.select(
        F.col("user_id").alias("set_id"),
        F.when(F.col("event_type") != "error", hour).alias("bit"),
        (F.col("event_type") != "signup").alias("value"),
        F.col("event_id").alias("seq"),
    )
    members = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("set_id"), F.col("c_nationkey").cast("bigint").alias("bit")
    )
    return ops.update(members, updates)


def bitset_flip(spark, sf_dir):
    return ops.unpack(ops.flip(_b(spark, sf_dir), line_sets(spark, sf_dir)))


def bitset_hash(spark, sf_dir):
    return ops.hash_code(_a(spark, sf_dir))


def bitset_equal_groups(spark, sf_dir):
    return ops.equal_groups(ops.pack(order_line_sets(spark, sf_dir)))


def bitset_to_string(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("set_id"))
    return ops.to_text(ops.pack(order_line_sets(spark, sf_dir)), orders)


def bitset_text_segments(spark, sf_dir):
    """Sets of orders by line number, written in segments of 16 words; sets of ``_all_sets`` without members too."""
    return ops.to_text_segments(_a(spark, sf_dir), _all_sets(spark, sf_dir), WORDS_PER_SEGMENT)


def bitset_runs(spark, sf_dir):
    return nav.runs(line_sets(spark, sf_dir))


def bitset_next_set(spark, sf_dir):
    return nav.next_set(line_sets(spark, sf_dir), _probes(spark, sf_dir))


def bitset_prev_set(spark, sf_dir):
    return nav.previous_set(line_sets(spark, sf_dir), _probes(spark, sf_dir))


# Below the range of the order keys, so that answers do run out of it.
CAPACITY = 1_024


def bitset_next_clear(spark, sf_dir):
    return nav.next_clear(line_sets(spark, sf_dir), _probes(spark, sf_dir), CAPACITY)


def bitset_prev_clear(spark, sf_dir):
    return nav.previous_clear(line_sets(spark, sf_dir), _probes(spark, sf_dir), CAPACITY)


def bitset_next_clear_unbounded(spark, sf_dir):
    return nav.next_clear(line_sets(spark, sf_dir), _probes(spark, sf_dir))


def bitset_prev_clear_unbounded(spark, sf_dir):
    return nav.previous_clear(line_sets(spark, sf_dir), _probes(spark, sf_dir))


def _half_of_keys(spark, sf_dir) -> int:
    """Half of the largest order key, in whole words: about half of the probes lie past it, whatever the data."""
    largest = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] or 0
    return largest // 128 * 64


def bitset_next_clear_half(spark, sf_dir):
    return nav.next_clear(line_sets(spark, sf_dir), _probes(spark, sf_dir), _half_of_keys(spark, sf_dir))


def bitset_prev_clear_half(spark, sf_dir):
    return nav.previous_clear(line_sets(spark, sf_dir), _probes(spark, sf_dir), _half_of_keys(spark, sf_dir))


QUERIES = {
    name: globals()[name]
    for name in [
        "bitset_build", "bitset_cardinality", "bitset_length", "bitset_get", "bitset_or", "bitset_and",
        "bitset_xor", "bitset_andnot", "bitset_intersects", "bitset_set_range", "bitset_update",
        "bitset_flip", "bitset_hash", "bitset_equal_groups", "bitset_to_string", "bitset_text_segments", "bitset_runs",
        "bitset_next_set", "bitset_prev_set", "bitset_next_clear", "bitset_prev_clear",
        "bitset_next_clear_unbounded", "bitset_prev_clear_unbounded", "bitset_next_clear_half", "bitset_prev_clear_half",
    ]
}

_WITH = f"WITH {SETS_SQL}"
_ALL_SETS = "all_sets AS (SELECT n_nationkey AS set_id FROM nation UNION SELECT set_id FROM line_sets)"
_RUNS = """islands AS (
  SELECT set_id, bit, bit - row_number() OVER (PARTITION BY set_id ORDER BY bit) AS island FROM line_sets),
runs AS (
  SELECT set_id, min(bit) AS run_start, max(bit) AS run_end FROM islands GROUP BY set_id, island)"""
_HALF = "half AS (SELECT coalesce(max(o_orderkey), 0) // 128 * 64 AS capacity FROM orders)"

ORACLES = {
    "bitset_build": f"{_WITH} SELECT set_id, bit FROM line_sets",
    "bitset_cardinality": f"""{_WITH}, {_ALL_SETS}
SELECT set_id, count(bit) AS cardinality, count(bit) = 0 AS is_empty
FROM all_sets LEFT JOIN line_sets USING (set_id) GROUP BY set_id""",
    "bitset_length": f"""{_WITH}, {_ALL_SETS}
SELECT set_id, coalesce(max(bit) + 1, 0) AS logical_length
FROM all_sets LEFT JOIN line_sets USING (set_id) GROUP BY set_id""",
    "bitset_get": f"""{_WITH}
SELECT p.set_id, p.bit, l.bit IS NOT NULL AS is_set
FROM priority_sets p LEFT JOIN line_sets l ON l.set_id = p.set_id AND l.bit = p.bit""",
    "bitset_or": f"{_WITH} SELECT set_id, bit FROM line_sets UNION SELECT set_id, bit FROM priority_sets",
    "bitset_and": f"{_WITH} SELECT set_id, bit FROM line_sets INTERSECT SELECT set_id, bit FROM priority_sets",
    "bitset_xor": f"""{_WITH}
SELECT set_id, bit FROM (SELECT * FROM line_sets UNION ALL SELECT * FROM priority_sets)
GROUP BY set_id, bit HAVING count(*) = 1""",
    "bitset_andnot": f"{_WITH} SELECT set_id, bit FROM line_sets EXCEPT SELECT set_id, bit FROM priority_sets",
    "bitset_intersects": f"""{_WITH}
SELECT s.set_id, EXISTS (
  SELECT 1 FROM line_sets l JOIN priority_sets p ON l.set_id = p.set_id AND l.bit = p.bit WHERE l.set_id = s.set_id
) AS intersects
FROM (SELECT set_id FROM line_sets UNION SELECT set_id FROM priority_sets) s""",
    "bitset_set_range": """SELECT DISTINCT set_id, bit FROM (
  SELECT l_suppkey AS set_id, unnest(range(l_orderkey, l_orderkey + l_linenumber - 1)) AS bit FROM lineitem
  UNION ALL SELECT s_suppkey, s_suppkey FROM supplier)""",
    "bitset_update": """WITH clears AS (
  SELECT user_id, max(event_id) AS clear_seq FROM events WHERE event_type = 'error' GROUP BY user_id),
writes AS (
  SELECT user_id AS set_id, CAST(extract(hour FROM ts) AS BIGINT) AS bit, event_type <> 'signup' AS value, event_id AS seq
  FROM events WHERE event_type <> 'error'
  UNION ALL
  SELECT c_custkey, CAST(c_nationkey AS BIGINT), true, -1 FROM customer),
latest AS (SELECT *, row_number() OVER (PARTITION BY set_id, bit ORDER BY seq DESC) AS rn FROM writes)
SELECT set_id, bit FROM latest LEFT JOIN clears ON user_id = set_id
WHERE rn = 1 AND value AND (clear_seq IS NULL OR seq > clear_seq)""",
    "bitset_flip": f"""{_WITH}
SELECT set_id, bit FROM (
  SELECT set_id, bit FROM priority_sets
  UNION ALL SELECT l_linenumber, l_orderkey FROM lineitem)
GROUP BY set_id, bit HAVING count(*) % 2 = 1""",
    "bitset_hash": f"""{_WITH},
words AS (
  SELECT set_id, bit // 64 AS ix, sum(CAST(1 AS HUGEINT) << CAST(bit % 64 AS INTEGER)) AS word
  FROM line_sets GROUP BY 1, 2),
mixed AS (
  SELECT set_id, xor(bit_xor(CAST((word * (ix + 1)) % 18446744073709551616 AS HUGEINT)), CAST(1234 AS HUGEINT)) AS h
  FROM words GROUP BY set_id),
low AS (
  SELECT set_id, xor(h // 4294967296, h) % 4294967296 AS code
  FROM mixed)
SELECT set_id, CAST(CASE WHEN code >= 2147483648 THEN code - 4294967296 ELSE code END AS BIGINT) AS hash_code
FROM low""",
    "bitset_equal_groups": f"""{_WITH},
contents AS (
  SELECT set_id, string_agg(CAST(bit AS VARCHAR), ',' ORDER BY bit) AS content FROM order_line_sets GROUP BY set_id)
SELECT set_id, min(set_id) OVER (PARTITION BY content) AS leader, count(*) OVER (PARTITION BY content) AS n_sets
FROM contents""",
    "bitset_to_string": f"""{_WITH}
SELECT o_orderkey AS set_id, '{{' || coalesce(string_agg(CAST(bit AS VARCHAR), ', ' ORDER BY bit), '') || '}}' AS text
FROM orders LEFT JOIN order_line_sets ON set_id = o_orderkey GROUP BY o_orderkey""",
    "bitset_text_segments": f"""{_WITH}, {_ALL_SETS},
parts AS (
  SELECT set_id, bit // {64 * WORDS_PER_SEGMENT} AS segment, string_agg(CAST(bit AS VARCHAR), ', ' ORDER BY bit) AS part
  FROM line_sets GROUP BY ALL),
texts AS (
  SELECT set_id, segment, CASE WHEN lag(segment) OVER ordered IS NULL THEN '{{' ELSE ', ' END || part
    || CASE WHEN lead(segment) OVER ordered IS NULL THEN '}}' ELSE '' END AS text
  FROM parts WINDOW ordered AS (PARTITION BY set_id ORDER BY segment))
SELECT set_id, CAST(segment AS BIGINT) AS segment, CAST(coalesce(sum(length(text)) OVER (
  PARTITION BY set_id ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, text FROM texts
UNION ALL SELECT set_id, 0, 0, '{{}}' FROM all_sets WHERE set_id NOT IN (SELECT set_id FROM line_sets)""",
    "bitset_runs": f"{_WITH}, {_RUNS} SELECT set_id, run_start, run_end FROM runs",
    "bitset_next_set": f"""{_WITH}
SELECT p.set_id, p.bit AS from_bit, coalesce(l.bit, -1) AS next_set
FROM priority_sets p ASOF LEFT JOIN line_sets l ON l.set_id = p.set_id AND p.bit <= l.bit""",
    "bitset_prev_set": f"""{_WITH}
SELECT p.set_id, p.bit AS from_bit, coalesce(l.bit, -1) AS previous_set
FROM priority_sets p ASOF LEFT JOIN line_sets l ON l.set_id = p.set_id AND p.bit >= l.bit""",
    "bitset_next_clear": f"""{_WITH}, {_RUNS}
SELECT p.set_id, p.bit AS from_bit,
  CASE WHEN coalesce(r.run_end + 1, p.bit) < {CAPACITY} THEN coalesce(r.run_end + 1, p.bit) ELSE -1 END AS next_clear
FROM priority_sets p LEFT JOIN runs r ON r.set_id = p.set_id AND p.bit BETWEEN r.run_start AND r.run_end""",
    "bitset_prev_clear": f"""{_WITH}, {_RUNS}
SELECT p.set_id, p.bit AS from_bit,
  CASE WHEN p.bit >= {CAPACITY} OR r.run_start IS NULL THEN p.bit ELSE r.run_start - 1 END AS previous_clear
FROM priority_sets p LEFT JOIN runs r ON r.set_id = p.set_id AND p.bit BETWEEN r.run_start AND r.run_end""",
    "bitset_next_clear_unbounded": f"""{_WITH}, {_RUNS}
SELECT p.set_id, p.bit AS from_bit, coalesce(r.run_end + 1, p.bit) AS next_clear
FROM priority_sets p LEFT JOIN runs r ON r.set_id = p.set_id AND p.bit BETWEEN r.run_start AND r.run_end""",
    "bitset_prev_clear_unbounded": f"""{_WITH}, {_RUNS}
SELECT p.set_id, p.bit AS from_bit, coalesce(r.run_start - 1, p.bit) AS previous_clear
FROM priority_sets p LEFT JOIN runs r ON r.set_id = p.set_id AND p.bit BETWEEN r.run_start AND r.run_end""",
    "bitset_next_clear_half": f"""{_WITH}, {_RUNS}, {_HALF}
SELECT p.set_id, p.bit AS from_bit,
  CASE WHEN coalesce(r.run_end + 1, p.bit) < capacity THEN coalesce(r.run_end + 1, p.bit) ELSE -1 END AS next_clear
FROM half CROSS JOIN priority_sets p
LEFT JOIN runs r ON r.set_id = p.set_id AND p.bit BETWEEN r.run_start AND r.run_end""",
    "bitset_prev_clear_half": f"""{_WITH}, {_RUNS}, {_HALF}
SELECT p.set_id, p.bit AS from_bit,
  CASE WHEN p.bit >= capacity OR r.run_start IS NULL THEN p.bit ELSE r.run_start - 1 END AS previous_clear
FROM half CROSS JOIN priority_sets p
LEFT JOIN runs r ON r.set_id = p.set_id AND p.bit BETWEEN r.run_start AND r.run_end""",
}
