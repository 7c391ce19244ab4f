import random

import pytest
from conftest import row_set

from latticework.operators import navigation as nav

CAPACITY = 1_000


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(9)
    sets = {
        0: set(rng.sample(range(1_000), 700)),
        1: set(rng.sample(range(1_000), 30)),
        2: set(range(60, 700)),
        3: {0, 63, 64, 127, 128, 255, 256, 999},
        4: set(range(1_024)),
    }
    members = spark.createDataFrame([(s, b) for s, v in sets.items() for b in v], "set_id int, bit bigint")
    probes = [(s, p) for s in [*sets, 5] for p in [*range(0, 1_100, 3), 63, 64, 255, 256, 999, 1_023, 1_024]]
    # One probe is repeated often, and carries a column of its own.
    rows = [(s, p, f"{s}/{p}") for s, p in probes] + [(1, 500, "hot")] * 300
    return sets, members.unionAll(members).cache(), spark.createDataFrame(rows, "set_id int, from_bit bigint, tag string").cache(), rows


def check(result, rows, expected):
    got = sorted(tuple(r) for r in result.collect())
    assert got == sorted((s, p, tag, expected(s, p)) for s, p, tag in rows)


@pytest.mark.parametrize("shift", [6, 7, 20])
def test_nearest_members(data, shift):
    sets, members, probes, rows = data
    check(
        nav.next_set(members, probes, shift), rows,
        lambda s, p: min((b for b in sets.get(s, ()) if b >= p), default=-1),
    )
    check(
        nav.previous_set(members, probes, shift), rows,
        lambda s, p: max((b for b in sets.get(s, ()) if b <= p), default=-1),
    )


def free_after(bits, p):
    while p in bits:
        p += 1
    return p


def free_before(bits, p):
    while p in bits:
        p -= 1
    return p


@pytest.mark.parametrize("shift", [6, 7, 20])
def test_free_positions(data, shift):
    sets, members, probes, rows = data
    whole = -(-CAPACITY // 64) * 64

    def next_free(s, p):
        found = free_after(sets.get(s, set()), p)
        return found if found < whole else -1

    check(nav.next_clear(members, probes, CAPACITY, shift), rows, next_free)
    check(nav.next_clear(members, probes, None, shift), rows, lambda s, p: free_after(sets.get(s, set()), p))
    check(
        nav.previous_clear(members, probes, CAPACITY, shift), rows,
        lambda s, p: p if p >= whole else free_before(sets.get(s, set()), p),
    )


def plain_runs(bits):
    out = []
    for b in sorted(bits):
        if out and out[-1][1] == b - 1:
            out[-1][1] = b
        else:
            out.append([b, b])
    return {tuple(r) for r in out}


@pytest.mark.parametrize("shift", [6, 7, 8, 20])
def test_runs(data, shift):
    sets, members, _, _ = data
    want = {(s, *run) for s, bits in sets.items() for run in plain_runs(bits)}
    rows = [tuple(r) for r in nav.runs(members, shift).collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_runs_of_extreme_words(spark):
    sets = {1: set(range(64)), 2: set(range(63)), 3: set(range(1, 64)), 4: {63}, 5: set(range(64, 256)), 6: {63, 64}}
    members = spark.createDataFrame([(s, b) for s, v in sets.items() for b in v], "set_id int, bit bigint")
    assert row_set(nav.runs(members)) == {(s, *r) for s, v in sets.items() for r in plain_runs(v)}


def test_previous_clear_before_zero(spark):
    members = spark.createDataFrame([(1, 0), (1, 1)], "set_id int, bit bigint")
    probes = spark.createDataFrame([(1, 1), (1, -1)], "set_id int, from_bit bigint")
    assert row_set(nav.previous_clear(members, probes)) == {(1, 1, -1), (1, -1, -1)}
    assert row_set(nav.previous_set(members, probes)) == {(1, 1, 1), (1, -1, -1)}


@pytest.mark.parametrize("bits", [[(i * 7919) << 24 for i in range(400)], list(range(3_000)) + [1 << 40, (1 << 62) + 5]])
def test_no_window_holds_a_whole_set(spark, monkeypatch, bits):
    """Sparse and dense sets through all levels of small blocks."""
    monkeypatch.setattr(nav, "LEVEL_SHIFT", 6)
    monkeypatch.setattr(nav, "LAST_BITS", 8)
    members = spark.createDataFrame([(1, b) for b in bits], "set_id int, bit bigint")
    asked = sorted({b + d for b in bits[::37] + bits[-2:] for d in (-1, 0, 1) if b + d >= 0})
    probes = spark.createDataFrame([(1, a) for a in asked], "set_id int, from_bit bigint")
    inside = set(bits)

    def clear(at, step):
        while at in inside:
            at += step
        return at

    got = {r["from_bit"]: r["next_set"] for r in nav.next_set(members, probes, 8).collect()}
    assert got == {a: min((b for b in bits if b >= a), default=-1) for a in asked}
    got = {r["from_bit"]: r["previous_set"] for r in nav.previous_set(members, probes, 8).collect()}
    assert got == {a: max((b for b in bits if b <= a), default=-1) for a in asked}
    got = {r["from_bit"]: r["next_clear"] for r in nav.next_clear(members, probes, None, 8).collect()}
    assert got == {a: clear(a, 1) for a in asked}
    got = {r["from_bit"]: r["previous_clear"] for r in nav.previous_clear(members, probes, None, 8).collect()}
    assert got == {a: clear(a, -1) for a in asked}
