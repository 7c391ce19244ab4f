import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from latticework.operators import chunks as ops
from latticework.session import scratch_dir
from latticework.streaming import chunks as streams
from latticework.streaming.runs import run_available

TEXTS = ["", "a", "abcd", "abcdefgh", "ab\ncd\"e;f", "äöü€𝄞xyz" * 3, "<content>" * 1000]


@pytest.fixture(scope="module")
def messages(spark):
    rows = list(enumerate(TEXTS)) + [(99, None)]
    return spark.createDataFrame(rows, "msg bigint, body string")


@pytest.mark.parametrize("size", [1, 4, 7, 260_001])
@pytest.mark.parametrize("unit", ["bytes", "chars"])
def test_round_trip_after_a_shuffle(messages, size, unit):
    parts = ops.split(messages, "msg", "body", size, unit).orderBy(F.rand(7))
    got = {r["msg_id"]: r["value"] for r in ops.reassemble(parts, as_text=True).collect()}
    assert got == dict(enumerate(TEXTS))


def test_chunks_are_numbered_and_sized(messages):
    rows = ops.split(messages, "msg", "body", 4, "chars").collect()
    by_msg = {}
    for r in rows:
        by_msg.setdefault(r["msg_id"], []).append((r["key"], r["chunk"], r["n_chunks"]))
    assert sorted(by_msg[0]) == [(1, "", 1)]
    assert sorted(by_msg[2]) == [(1, "abcd", 1)]
    assert sorted(by_msg[3]) == [(1, "abcd", 2), (2, "efgh", 2)]
    assert 99 not in by_msg


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=40), max_size=6), st.integers(1, 9))
def test_round_trip_of_any_text(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "msg bigint, body string")
    for unit in ("bytes", "chars"):
        parts = ops.split(df, "msg", "body", size, unit)
        got = {r["msg_id"]: r["value"] for r in ops.reassemble(parts, as_text=True).collect()}
        assert got == dict(enumerate(texts))


def test_binary_values_keep_every_byte(spark):
    body = bytes(range(256)) * 5
    df = spark.createDataFrame([(1, bytearray(body))], "msg int, body binary")
    row = ops.reassemble(ops.split(df, "msg", "body", 100)).first()
    assert bytes(row["value"]) == body and row["n_chunks"] == 13


def test_missing_and_repeated_chunks(messages):
    parts = ops.split(messages, "msg", "body", 4, "chars")
    damaged = parts.where("not (msg_id = 3 and key = 2)").unionByName(parts.where("msg_id = 6"))
    got = {r["msg_id"]: (r["n_seen"], r["value"]) for r in ops.reassemble(damaged).collect()}
    assert got[3] == (1, None)
    assert got[6] == (2250, TEXTS[6])


def test_long_text_in_many_parts(spark):
    text = "aß𝄞" * 5_000
    df = spark.createDataFrame([(1, text), (2, text[:128 * 7]), (3, text[:128 * 7 + 1])], "msg int, body string")
    rows = ops.split(df, "msg", "body", 7, "chars").collect()
    for msg, body in [(1, text), (2, text[:128 * 7]), (3, text[:128 * 7 + 1])]:
        got = sorted((r["key"], r["chunk"]) for r in rows if r["msg_id"] == msg)
        assert got == [(i // 7 + 1, body[i:i + 7]) for i in range(0, len(body), 7)]


def test_bad_arguments(messages):
    with pytest.raises(ValueError):
        ops.split(messages, "msg", "body", 0)
    with pytest.raises(ValueError):
        ops.split(messages, "msg", "body", 4, "words")


def test_stream_reports_each_message_once(spark, messages):
    path = scratch_dir(spark, "test-chunks")
    parts = ops.split(messages, "msg", "body", 4, "chars")
    damaged = parts.where("not (msg_id = 3 and key = 2)").unionByName(parts.where("msg_id = 6"))
    streams.write_chunks(damaged, path, "2024-01-01 00:00:00")
    # A whole message arrives again in a later file.
    streams.write_chunks(parts.where("msg_id = 2"), path, "2024-01-01 00:00:00")
    schema = spark.read.parquet(path).schema
    streams.write_end_mark(spark, schema, path, "2024-01-01 03:00:00")
    stream = streams.stream_chunks(spark, path, schema)
    rows = run_available(streams.stream_reassemble(stream), "test-whole").collect()
    got = {r["msg_id"]: (r["n_seen"], r["value"]) for r in rows}
    assert len(rows) == len(TEXTS)
    assert got.pop(3) == (1, None)
    assert {k: v for k, (_, v) in got.items()} == {k: v for k, v in enumerate(TEXTS) if k != 3}


def test_stream_drops_state_of_incomplete_messages(spark, messages):
    """Messages sent much later push an unfinished one out, as incomplete."""
    path = scratch_dir(spark, "test-late")
    parts = ops.split(messages, "msg", "body", 4, "chars")
    streams.write_chunks(parts.where("msg_id = 3 and key = 1"), path, "2024-01-01 00:00:00")
    # Rows count as late one batch after the watermark has moved.
    for later in (2, 4):
        streams.write_chunks(parts.where(f"msg_id = {later}"), path, "2024-01-01 05:00:00")
    streams.write_chunks(parts.where("msg_id = 3 and key = 2"), path, "2024-01-01 00:00:00")
    schema = spark.read.parquet(path).schema
    stream = streams.stream_chunks(spark, path, schema)
    rows = run_available(streams.stream_reassemble(stream), "test-late-out").collect()
    assert [(r["msg_id"], r["n_seen"], r["value"]) for r in rows] == [(3, 1, None)]


def test_conflicts_gaps_and_extra_chunks_are_not_complete(spark):
    rows = [
        (1, 2, 1, "A"), (1, 2, 1, "B"), (2, 2, 1, "A"), (2, 2, 2, "B"), (2, 2, 1, "A"), (3, 2, 2, "B"), (3, 2, 3, "C"),
        (4, 1, 1, "A"), (4, 1, 2, "B"), (5, 2, 1, "A"), (5, 2, 2, "B"), (5, 2, 2, "C"), (6, 1, None, "A"), (7, 1, 1, None),
    ]
    parts = spark.createDataFrame(rows, "msg_id int, n_chunks int, key int, chunk string")
    want = {1: (1, None), 2: (2, "AB"), 3: (2, None), 4: (2, None), 5: (2, None), 7: (1, None)}
    assert {r["msg_id"]: (r["n_seen"], r["value"]) for r in ops.reassemble(parts).collect()} == want
    path = scratch_dir(spark, "test-conflicts")
    streams.write_chunks(parts.where("chunk IS NOT NULL AND key IS NOT NULL"), path, "2024-01-01 00:00:00")
    schema = spark.read.parquet(path).schema
    streams.write_end_mark(spark, schema, path, "2024-01-01 03:00:00")
    stream = streams.stream_reassemble(streams.stream_chunks(spark, path, schema))
    got = {r["msg_id"]: (r["n_seen"], r["value"]) for r in run_available(stream, "test-conflicts-out").collect()}
    del want[7]
    assert got == want


def test_messages_are_handed_on_when_complete(spark):
    schema = "msg_id int, n_chunks int, sent_at timestamp, key int, chunk string"
    day, next_day = "2024-01-01 00:00:00", "2024-01-02 00:00:00"

    def batch(rows):
        texts = spark.createDataFrame(rows, schema.replace("timestamp", "string"))
        return texts.withColumn("sent_at", F.col("sent_at").cast("timestamp"))

    assembly = streams.Assembly(spark, scratch_dir(spark, "test-assembly"), batch([(1, 1, day, 1, "")]).schema)
    assert assembly.messages().collect() == [] and tuple(assembly.account().first()) == (0, 0, 0, 0, 0)
    batches = [
        # One message complete, one open, one with an empty chunk; a replay, a key without a place and nulls.
        [(1, 2, day, 2, "b"), (1, 2, day, 1, "a"), (1, 2, day, 1, "a"), (2, 2, day, 1, "c"), (3, 1, day, 1, ""), (4, 3, day, 1, "x"),
         (4, 3, day, 4, "?"), (None, 1, day, 1, "n"), (5, 1, None, 1, "n"), (5, 1, day, None, "n")],
        # The open one is completed; a replay of an ended message, another content of a known key.
        [(2, 2, day, 2, "d"), (1, 2, day, 2, "b"), (4, 3, day, 1, "y")],
        [],
        # A day later the open message ends, and what is sent of the old time is late.
        [(6, 1, next_day, 1, "z")],
        [(4, 3, day, 2, "x"), (1, 2, day, 1, "a")],
    ]
    seen = []
    for number, rows in enumerate(batches):
        # A batch that is repeated after a failure changes nothing.
        for _ in range(2):
            assembly.add(batch(rows), number)
        seen.append(sorted((r.msg_id, r.n_chunks, r.n_seen, r.value) for r in assembly.table("messages", number).collect()))
    assert seen == [[(1, 2, 2, "ab"), (3, 1, 1, "")], [(2, 2, 2, "cd")], [], [(4, 3, 1, None), (6, 1, 1, "z")], []]
    assert assembly.messages().count() == 5
    assert tuple(assembly.account().first()) == (16, 7, 3, 4, 2)
    assert assembly.table("open", 4).count() == 0 and assembly.table("ended", 4).count() == 1


def test_assembly_goes_on_where_a_run_ended(spark, messages):
    path = scratch_dir(spark, "test-runs")
    parts = ops.split(messages, "msg", "body", 4, "bytes")
    schema = parts.withColumn("sent_at", F.lit("2024-01-01").cast("timestamp")).schema
    where = scratch_dir(spark, "test-runs-state")
    for rows in (parts.where("key < n_chunks"), parts):
        streams.write_chunks(rows, path, "2024-01-01 00:00:00")
        streams.Assembly(spark, where, schema).run(streams.stream_chunks(spark, path, schema, files_per_batch=3))
    assembly = streams.Assembly(spark, where, schema)
    got = {r.msg_id: bytes(r.value).decode() for r in assembly.messages().collect()}
    assert got == dict(enumerate(TEXTS)) and assembly.messages().count() == len(TEXTS)
    n, again = parts.count(), parts.where("key < n_chunks").count()
    assert tuple(assembly.account().first()) == (n + again, n, again, 0, 0)


@pytest.mark.parametrize("per_segment", [1, 3, 64])
@pytest.mark.parametrize("unit", ["bytes", "chars"])
def test_segments_join_to_the_value(messages, unit, per_segment):
    parts = ops.split(messages, "msg", "body", 4, unit)
    parts = parts.unionByName(parts.where("key % 3 = 1")).orderBy(F.rand(5))
    rows = ops.segments(parts, per_segment).collect()
    empty = b"" if unit == "bytes" else ""
    for i, text in enumerate(TEXTS):
        own = sorted((r for r in rows if r["msg_id"] == i), key=lambda r: r["segment"])
        value = text.encode() if unit == "bytes" else text
        assert empty.join(r["part"] for r in own) == value
        assert [r["segment"] for r in own] == list(range(len(own))) and len(own) == -(-own[0]["n_chunks"] // per_segment)
        assert all(r["size"] == len(r["part"]) and value[r["start"] : r["start"] + r["size"]] == r["part"] for r in own)
    assert {r["msg_id"] for r in rows} == set(range(len(TEXTS)))


def test_segments_of_damaged_messages(spark):
    rows = [(1, 3, k, c) for k, c in ((1, "a"), (3, "c"))] + [(2, 2, 1, "a"), (2, 2, 2, "b"), (2, 2, 2, "x")]
    rows += [(3, 2, 1, "a"), (3, 2, 2, "b"), (3, 2, 3, "c"), (4, 2, 0, "a"), (4, 2, 1, "b"), (5, None, 1, "a"), (6, 1, 1, None)]
    rows += [(None, 2, 2, "b"), (None, 2, 1, "a"), (None, 2, None, "z"), (None, 2, 1, "a"), (7, 1, 1, "y"), (7, 2, 1, "y")]
    parts = spark.createDataFrame(rows, "msg_id int, n_chunks int, key int, chunk string")
    want = {(r["msg_id"], r["value"]) for r in ops.reassemble(parts).collect() if r["value"] is not None}
    got = ops.segments(parts, 2)
    assert {(r["msg_id"], r["part"]) for r in got.collect()} == want == {(None, "ab"), (7, "y")}
    assert got.columns == ["msg_id", "n_chunks", "segment", "start", "size", "part"]
    assert ops.segments(parts.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ops.segments(parts, 0)
