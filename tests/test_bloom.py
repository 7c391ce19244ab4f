import random

import pytest
from conftest import row_set
from pyspark.sql import functions as F

from latticework.functions.hashing import bucket, text_bucket
from latticework.operators import bloom as ops
from latticework.operators.bitset import pack
from latticework.streaming.seen import Seen


def plain_bucket(key, size):
    h = key ^ 1234
    code = ((h >> 32) ^ h) & 0xFFFFFFFF
    code = code - (1 << 32) if code >= 1 << 31 else code
    return abs(code) % size


KEYS = [0, 1, -1, 1234, 2**31 - 1, 2**31, -(2**31), 2**63 - 1, -(2**63), 2**40 + 17]


@pytest.mark.parametrize("size", [1, 64, 1_000, 167_772_160])
def test_bucket_formula(spark, size):
    rng = random.Random(2)
    keys = KEYS + [rng.randrange(-(2**63), 2**63) for _ in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = dict(row_set(df.select("k", bucket(F.col("k"), size))))
    assert got == {k: plain_bucket(k, size) for k in keys}


def test_bucket_of_a_key_is_that_of_its_one_word_set(spark):
    bits = {5: [0, 3], 6: [63], 7: [1, 2, 62]}
    words = pack(spark.createDataFrame([(s, b) for s, v in bits.items() for b in v], "set_id int, bit bigint"))
    by_set = dict(row_set(ops.set_buckets(words, 999)))
    by_key = dict(row_set(words.select("set_id", bucket(F.col("word"), 999))))
    assert by_set == by_key


def test_no_member_is_missed_and_sides_are_complementary(spark):
    build = spark.range(0, 4_000, 7).toDF("k")
    probe = spark.range(0, 6_000).toDF("k")
    for size in (1_024, 1_000_003):
        words = ops.build(build, "k", size)
        maybe = {r[0] for r in ops.semi_join(probe, "k", words, size).collect()}
        never = {r[0] for r in ops.anti_join(probe, "k", words, size).collect()}
        assert set(range(0, 4_000, 7)) <= maybe
        assert maybe | never == set(range(6_000)) and not maybe & never
        filled = {plain_bucket(k, size) for k in range(0, 4_000, 7)}
        assert maybe == {k for k in range(6_000) if plain_bucket(k, size) in filled}


def test_large_filters_are_joined_without_broadcast(spark, monkeypatch):
    build, probe = spark.range(0, 100).toDF("k"), spark.range(50, 200).toDF("k")
    words = ops.build(build, "k", 100_000)
    want = row_set(ops.semi_join(probe, "k", words, 100_000))
    monkeypatch.setattr(ops, "BROADCAST_WORDS", 1)
    joined = ops.semi_join(probe, "k", words, 100_000)
    assert row_set(joined) == want == {(k,) for k in range(50, 100)}


def test_default_size_holds_single_keys(spark):
    words = ops.build(spark.range(10).toDF("k"), "k")
    assert words.count() == 1
    assert ops.semi_join(spark.range(30).toDF("k"), "k", words).count() == 10


def test_text_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    words = ops.build(df, "k", 4_096)
    probe = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert row_set(ops.semi_join(probe, "k", words, 4_096)) == {("a",), ("b",)}
    assert row_set(ops.anti_join(probe, "k", words, 4_096)) == {("c",), (None,)}
    assert row_set(df.where("k = 'a'").select(text_bucket(F.col("k"), 1 << 40))).pop()[0] < 1 << 40


def test_groups_and_merge(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), ("y", 2)], "g string, k bigint")
    by_group = ops.build(df, "k", 256, by="g")
    assert row_set(ops.buckets(by_group)) == {(g, plain_bucket(k, 256)) for g, k in [("x", 1), ("x", 2), ("y", 3), ("y", 2)]}
    other = ops.build(spark.range(9, 10).toDF("k"), "k", 256)
    merged = row_set(ops.buckets(ops.merge(by_group, other)))
    assert merged == {(plain_bucket(k, 256),) for k in (1, 2, 3, 9)}


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_first_seen(spark, monkeypatch, limit):
    monkeypatch.setattr(ops, "BROADCAST_BUCKETS", limit)
    rng = random.Random(4)
    # A third of the rows carries one key.
    rows = [(i, 17 if i % 3 == 0 else rng.randrange(200)) for i in range(600)]
    df = spark.createDataFrame(rows, "pos bigint, k bigint").repartition(5)
    seen, want = set(), {}
    for pos, k in rows:
        b = plain_bucket(k, 64)
        want[pos] = b not in seen
        seen.add(b)
    flags = ops.added_flags(df, "k", "pos", 64)
    assert {r["pos"]: r["added"] for r in flags.collect()} == want
    assert {r["pos"] for r in ops.first_seen(df, "k", "pos", 64).collect()} == {p for p, a in want.items() if a}


def test_prefilter_join_equals_the_plain_join(spark):
    probe = spark.range(0, 3_000).selectExpr("id as p", "id % 500 as k")
    side = spark.range(100, 700, 3).selectExpr("id as b", "id * 2 as v")
    got = row_set(ops.prefilter_join(probe, "k", side, "b", 128))
    assert got == row_set(probe.join(side, probe["k"] == side["b"]))


def test_sizes_must_agree(spark):
    df = spark.range(5_000).withColumnRenamed("id", "k")
    words = ops.build(df, "k", 1_024)
    assert words.columns == ["word_ix", "word", "size"]
    with pytest.raises(Exception, match="another size"):
        ops.semi_join(df, "k", words, 4_096).collect()
    with pytest.raises(ValueError, match="cannot be merged"):
        ops.merge(words, ops.build(df, "k", 4_096))


def test_null_keys_stay_and_other_types_fail(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 5), (4, None)], "o int, k int")
    got = {r["o"]: (r["bucket"], r["added"]) for r in ops.added_flags(df, "k", "o", 64).collect()}
    assert got == {1: (plain_bucket(5, 64), True), 2: (None, False), 3: (plain_bucket(5, 64), False), 4: (None, False)}
    with pytest.raises(TypeError):
        ops.build(spark.createDataFrame([(1.2,), (1.7,)], "k double"), "k", 64)


def test_whole_sets_as_elements(spark):
    sets = {1: [1, 2], 2: [2, 1], 3: [1], 4: [70, 200], 5: [300]}
    rows = spark.createDataFrame([(s, b) for s, bits in sets.items() for b in bits], "set_id int, bit bigint")
    words = pack(rows)
    held = ops.build_of_sets(words.where("set_id IN (1, 4)"), 10_007)
    assert row_set(ops.semi_join_sets(words, held, 10_007)) == {(1,), (2,), (4,)}
    assert row_set(ops.anti_join_sets(words, held, 10_007)) == {(3,), (5,)}
    assert {r["set_id"] for r in ops.added_sets(words, 10_007).where("added").collect()} == {1, 3, 4, 5}


def test_size_follows_the_number_of_keys(spark):
    keys = spark.range(1000).selectExpr("id % 300 AS k")
    assert ops.size_for(keys, "k") == 8192 and ops.size_for(keys, "k", 8) == 4096
    assert ops.size_for(keys.limit(0), "k") == 64 and ops.size_for(keys.selectExpr("nullif(k, k) AS k"), "k") == 64


def _arrive(spark, path, rows):
    spark.createDataFrame(rows, "n bigint, k bigint").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("n bigint, k bigint").parquet(path)


def test_a_filter_lives_between_runs(spark, tmp_path):
    rng = random.Random(5)
    rows = [(n, rng.choice([None, *range(150)])) for n in range(400)]
    seen = Seen.fresh(spark, "k", "n", 64)
    path, parts = str(tmp_path / "in"), [rows[:100], rows[100:101], rows[101:300], rows[300:]]
    for part in parts:
        flags = seen.run_available(_arrive(spark, path, part))
    everything = spark.createDataFrame(rows, "n bigint, k bigint")
    assert seen.batches(spark) == 4
    assert row_set(flags) == row_set(ops.added_flags(everything, "k", "n", 64))
    assert row_set(ops.buckets(seen.words(spark))) == row_set(ops.buckets(ops.build(everything, "k", 64)))
    # A run without new input changes nothing.
    again = seen.run_available(spark.readStream.schema("n bigint, k bigint").parquet(path))
    assert row_set(again) == row_set(flags) and again.count() == 400


def test_a_repeated_batch_gives_the_same_flags(spark):
    seen = Seen.fresh(spark, "k", "n", 64)
    batches = [[(1, 5), (2, 5), (3, None)], [(4, 5), (5, 6)], [(6, 6), (7, 7), (8, 7)]]
    frames = [spark.createDataFrame(rows, "n bigint, k bigint") for rows in batches]
    want = [{1}, {5}, {7}]
    for number, frame in enumerate(frames):
        for _ in range(3):
            seen.add(frame, number)
            flags = spark.read.parquet(f"{seen.path}/flags/batch={number}")
            assert {r.n for r in flags.where("added").collect()} == want[number]
    assert ops.buckets(seen.words(spark)).count() == 3


def test_a_filter_without_input(spark, tmp_path):
    seen = Seen.fresh(spark, "k", "n", 64)
    (tmp_path / "in").mkdir()
    flags = seen.run_available(spark.readStream.schema("n bigint, k bigint").parquet(str(tmp_path / "in")))
    assert flags.columns == ["n", "k", "bucket", "added"] and flags.count() == 0
    assert seen.words(spark).count() == 0


def test_a_filter_of_another_size_is_refused(spark):
    seen = Seen.fresh(spark, "k", "n", 64)
    rows = spark.createDataFrame([(1, 1)], "n bigint, k bigint")
    seen.add(rows, 0)
    with pytest.raises(Exception, match="size"):
        Seen(seen.path, "k", "n", 128).add(rows, 1)
