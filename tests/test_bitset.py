import random

import pytest
from conftest import row_set

from latticework.operators import bitset as ops

EDGES = [0, 63, 64, 127, 128, 4095, 4096, 262_143, 262_144, 5_000_000]


def members(spark, sets):
    rows = [(s, b) for s, bits in sets.items() for b in bits]
    return spark.createDataFrame(rows, "set_id int, bit bigint")


def as_sets(df):
    out = {}
    for s, b in row_set(df):
        out.setdefault(s, set()).add(b)
    return out


def without_empty(sets):
    return {s: v for s, v in sets.items() if v}


@pytest.fixture(scope="module")
def two(spark):
    rng = random.Random(3)
    a = {s: set(rng.sample(range(300), 60)) for s in range(4)}
    b = {s: set(rng.sample(range(300), 60)) for s in range(2, 6)}
    a[7] = set(EDGES)
    b[7] = set(EDGES[::2])
    a[8], b[8] = {1, 2}, {3, 4}
    return a, b, ops.pack(members(spark, a)).cache(), ops.pack(members(spark, b)).cache()


def test_pack_and_unpack(two):
    a, _, pa, _ = two
    assert as_sets(ops.unpack(pa)) == a


@pytest.mark.parametrize(
    "op,plain",
    [
        (ops.set_or, set.union), (ops.set_and, set.intersection),
        (ops.set_xor, set.symmetric_difference), (ops.set_andnot, set.difference),
    ],
)
def test_set_operations(two, op, plain):
    a, b, pa, pb = two
    want = {s: plain(a.get(s, set()), b.get(s, set())) for s in a.keys() | b.keys()}
    assert as_sets(ops.unpack(op(pa, pb))) == without_empty(want)


def test_laws(two):
    _, _, pa, pb = two

    def count(words):
        return sum(r["cardinality"] for r in ops.cardinality(words).collect())

    assert count(pa) + count(pb) == count(ops.set_or(pa, pb)) + count(ops.set_and(pa, pb))
    # a \ b = a xor (a and b)
    left = row_set(ops.unpack(ops.set_andnot(pa, pb)))
    assert left == row_set(ops.unpack(ops.set_xor(pa, ops.set_and(pa, pb))))
    assert row_set(ops.unpack(ops.merge(pa, pb))) == row_set(ops.unpack(ops.set_or(pa, pb)))


def test_intersects(two):
    a, b, pa, pb = two
    got = dict(row_set(ops.intersects(pa, pb)))
    assert got == {s: bool(a.get(s, set()) & b.get(s, set())) for s in a.keys() | b.keys()}


def test_cardinality_and_length(spark, two):
    a, _, pa, _ = two
    sets = spark.createDataFrame([(s,) for s in [*a, 50]], "set_id int")
    card = {r["set_id"]: (r["cardinality"], r["is_empty"]) for r in ops.cardinality(pa, sets).collect()}
    assert card == {**{s: (len(v), False) for s, v in a.items()}, 50: (0, True)}
    length = dict(row_set(ops.logical_length(pa, sets)))
    assert length == {**{s: max(v) + 1 for s, v in a.items()}, 50: 0}


def test_get(spark, two):
    a, _, pa, _ = two
    rows = [(7, b + d) for b in EDGES for d in (0, 1)] + [(0, b) for b in range(300)] + [(50, 3)]
    probes = spark.createDataFrame(rows * 2, "set_id int, bit bigint")
    got = [tuple(r) for r in ops.get(pa, probes).collect()]
    assert sorted(got) == sorted((s, b, b in a.get(s, set())) for s, b in rows * 2)


RANGES = [
    (0, 0, 0), (0, 5, 5), (1, 0, 64), (2, 63, 65), (3, 10, 20), (3, 15, 200), (4, 100, 9_000),
    (4, 64, 4096), (5, 1, 600_000), (6, 262_144, 524_288), (6, 300_000, 300_001), (9, 127, 128),
    (10, 4_095, 4_097), (11, 262_143, 262_145), (12, 7, 3), (13, 4_096, 8_192), (13, 4_032, 8_256),
]


def test_set_range(spark):
    start = {1: {500}, 3: {12, 999}, 8: {1}}
    ranges = spark.createDataFrame(RANGES, "set_id int, from_bit bigint, to_bit bigint")
    got = as_sets(ops.unpack(ops.set_range(ops.pack(members(spark, start)), ranges)))
    want = {s: set(v) for s, v in start.items()}
    for s, lo, hi in RANGES:
        want.setdefault(s, set()).update(range(lo, hi))
    assert got == without_empty(want)


def test_set_range_random(spark):
    rng = random.Random(11)
    rows = []
    for s in range(30):
        lo = rng.randrange(0, 20_000)
        rows.append((s % 10, lo, lo + rng.choice([0, 1, 5, 64, 130, 4_096, 5_000, 9_999])))
    ranges = spark.createDataFrame(rows, "set_id int, from_bit bigint, to_bit bigint")
    none = ops.pack(spark.createDataFrame([], "set_id int, bit bigint"))
    want = {}
    for s, lo, hi in rows:
        want.setdefault(s, set()).update(range(lo, hi))
    assert as_sets(ops.unpack(ops.set_range(none, ranges))) == without_empty(want)


def test_update(spark):
    rng = random.Random(5)
    start = {s: set(rng.sample(range(100), 20)) for s in range(5)}
    want = {s: set(v) for s, v in start.items()}
    rows = []
    for seq in range(400):
        s = rng.randrange(6)
        bit = None if rng.random() < 0.02 else rng.randrange(100)
        value = rng.random() < 0.6
        rows.append((s, bit, value, seq))
        if bit is None:
            want[s] = set()
        elif value:
            want.setdefault(s, set()).add(bit)
        else:
            want.setdefault(s, set()).discard(bit)
    updates = spark.createDataFrame(rows, "set_id int, bit bigint, value boolean, seq bigint").repartition(7)
    assert as_sets(ops.update(members(spark, start), updates)) == without_empty(want)


def test_flip(spark):
    rng = random.Random(6)
    start = {s: set(rng.sample(range(200), 50)) for s in range(4)}
    flips = [(rng.randrange(5), rng.randrange(200)) for _ in range(500)]
    want = {s: set(v) for s, v in start.items()}
    for s, b in flips:
        want.setdefault(s, set()).symmetric_difference_update({b})
    df = spark.createDataFrame(flips, "set_id int, bit bigint")
    got = as_sets(ops.unpack(ops.flip(ops.pack(members(spark, start)), df)))
    assert got == without_empty(want)


def signed(value, width):
    value &= (1 << width) - 1
    return value - (1 << width) if value >> (width - 1) else value


def plain_hash(bits):
    h = 1234
    words = {}
    for b in bits:
        words[b >> 6] = words.get(b >> 6, 0) | 1 << (b & 63)
    for ix, word in words.items():
        h ^= word * (ix + 1)
    h = signed(h, 64)
    return signed((h >> 32) ^ h, 32)


def test_hash_code(two):
    a, _, pa, _ = two
    assert dict(row_set(ops.hash_code(pa))) == {s: plain_hash(v) for s, v in a.items()}


def test_equal_groups(spark):
    sets = {3: {1, 70}, 1: {1, 70}, 2: {1}, 9: {1, 70}, 4: {1, 71}, 5: {1 << 21, 4}, 6: {1 << 21, 4}}
    got = {r[0]: (r[1], r[2]) for r in row_set(ops.equal_groups(ops.pack(members(spark, sets))))}
    assert got == {3: (1, 3), 1: (1, 3), 9: (1, 3), 2: (2, 1), 4: (4, 1), 5: (5, 2), 6: (5, 2)}


def test_sets_that_share_a_signature_only_stay_apart(spark):
    sets = {3: {1, 70}, 1: {1, 70}, 2: {1}, 9: {1, 70}, 4: {1, 71}, 5: {1 << 21, 4}, 6: {1 << 21, 4}, 7: {1, 70, 900}, 8: {1}}
    forced = spark.createDataFrame([(i, "one" if i != 8 else "other") for i in sets], "set_id int, signature string")
    got = {r[0]: (r[1], r[2]) for r in row_set(ops.equal_groups(ops.pack(members(spark, sets)), forced))}
    want = {3: (1, 3), 1: (1, 3), 9: (1, 3), 2: (2, 1), 4: (4, 1), 5: (5, 2), 6: (5, 2), 7: (7, 1), 8: (8, 1)}
    assert got == want


def test_to_text(spark):
    sets = {1: {1, 2, 5}, 2: {64, 63, 200}, 3: {0}}
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "set_id int")
    got = dict(row_set(ops.to_text(ops.pack(members(spark, sets)), ids)))
    assert got == {1: "{1, 2, 5}", 2: "{63, 64, 200}", 3: "{0}", 4: "{}"}


def test_capacity_is_checked(spark):
    words = ops.pack(members(spark, {1: {3, 127}}))
    assert as_sets(ops.unpack(ops.bounded(words, 100))) == {1: {3, 127}}
    with pytest.raises(Exception, match="outside the capacity"):
        ops.bounded(words, 64).collect()


@pytest.mark.parametrize("words_per_segment", [1, 64, 10**6])
def test_text_segments_join_to_the_text(spark, words_per_segment):
    rng = random.Random(3)
    sets = {1: EDGES, 2: [rng.randrange(10**5) for _ in range(900)], 3: [], None: [5, 70], 4: [2**62, 7]}
    words = ops.pack(members(spark, sets))
    wanted = spark.createDataFrame([(1,), (3,), (3,)], "set_id int")
    rows = ops.to_text_segments(words, wanted, words_per_segment).collect()
    for s, bits in sets.items():
        own = sorted((r for r in rows if r["set_id"] == s), key=lambda r: r["segment"])
        text = "".join(r["text"] for r in own)
        assert text == "{" + ", ".join(map(str, sorted(set(bits)))) + "}"
        assert all(text[r["start"] : r["start"] + len(r["text"])] == r["text"] for r in own)
        assert [r["segment"] for r in own] == (sorted({b // 64 // words_per_segment for b in bits}) or [0])
