import hashlib
import itertools
import math

import pytest
from conftest import row_set

from latticework.operators import preimage as ops
from latticework.streaming import hints as stream_hints
from latticework.streaming.hints import stream_hint_match


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("alphabets", [["A"], ["AB"], ["ABC", "XYZ"], ["A", "BCD", "ABCDEF", "ABCDEFG"]])
def test_permutations_are_complete(spark, alphabets):
    df = spark.createDataFrame([(a,) for a in alphabets * 2], "alphabet string")
    rows = [tuple(r) for r in ops.permutations(df).collect()]
    want = {
        (a, "".join(p[:-1]), p[-1]) for a in alphabets for p in itertools.permutations(a)
    }
    assert len(rows) == sum(math.factorial(len(a)) for a in alphabets)
    assert set(rows) == want


def test_permutations_of_any_symbols(spark):
    df = spark.createDataFrame([("1é5ß.2",)], "alphabet string")
    got = row_set(ops.permutations(df))
    assert got == {("1é5ß.2", "".join(p[:-1]), p[-1]) for p in itertools.permutations("1é5ß.2")}


def test_tuples_are_complete(spark):
    domains = [("AB", 3), ("XYZ", 2), ("Q", 4), ("AB", 1)]
    df = spark.createDataFrame(domains * 2, "universe string, plen int")
    want = {(u, n, "".join(t)) for u, n in domains for t in itertools.product(u, repeat=n)}
    rows = [tuple(r) for r in ops.tuples(df).collect()]
    assert len(rows) == len(want) and set(rows) == want


RECORDS = [
    # id, alphabet, value, hints in plain form
    (1, "ABCDE", "ABBA", ["BCDE", "ABDE"[::-1], "ACDE"]),  # hints exclude A, C, B: value not in the rest
    (2, "ABCDE", "DEED", ["BCDE", "EDCA", "ABDE"]),  # excluded A, B, C; a hint in sorted order
    (3, "ABCDE", "AAAA", ["ABCD", "ABCD", "DBAE"]),  # equal hints
    (4, "XYZ", "ZX", ["ZX"]),
    (5, "XYZ", "YYX", []),  # no hint: the whole alphabet remains
    (6, "XYZ", "XXZ", ["not a hint"]),
    (7, "XYZ", "QQ", ["ZX"]),  # no solution
]
EXPECTED = {
    1: None, 2: "DEED", 3: "AAAA", 4: "ZX", 5: "YYX", 6: "XXZ", 7: None,
}


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, a, len(v), sha(v), [sha(h) for h in hints]) for i, a, v, hints in RECORDS]
    return spark.createDataFrame(
        rows, "id bigint, alphabet string, plen int, value_hash string, hints array<string>"
    )


@pytest.mark.parametrize("limit", [1_000_000, 200, 5, 0])
def test_recover_by_every_join_strategy(records, limit):
    got = {r["id"]: (r["value"], r["status"]) for r in ops.recover(records, broadcast_rows=limit).collect()}
    assert got == {i: (v, "found" if v else "unresolved") for i, v in EXPECTED.items()}


@pytest.mark.parametrize("limit", [1_000_000, 200, 5, 0])
def test_hints_name_the_excluded_symbol(records, limit):
    got = {(r["id"], r["hint_ix"]): r["excluded"] for r in ops.match_hints(records, broadcast_rows=limit).collect()}
    want = {}
    for i, alphabet, _, hints in RECORDS:
        for ix, hint in enumerate(hints, 1):
            left = set(alphabet) - set(hint)
            want[(i, ix)] = left.pop() if len(left) == 1 and len(hint) == len(alphabet) - 1 else None
    assert got == want


def test_many_hints_use_the_broadcast_candidates(spark, records):
    many = records.where("id = 4").selectExpr(
        "explode(sequence(1, 50)) as id", "alphabet", "plen", "value_hash", "hints"
    )
    assert {r["value"] for r in ops.recover(many).collect()} == {"ZX"}


def test_remaining_universe(records):
    got = {r["id"]: (r["excluded"], r["universe"]) for r in ops.remaining_universe(records).collect()}
    assert got[2] == (["A", "B", "C"], "DE")
    assert got[3] == (["C", "E"], "ABD")
    assert got[5] == ([], "XYZ")


def test_limits_are_decided_one_by_one(spark):
    alphabets = spark.createDataFrame([("ABCDEFGHIJKLM",), ("ABC",)], "alphabet string")
    assert {r["alphabet"] for r in ops.permutations(alphabets, max_candidates=1000).collect()} == {"ABC"}
    domains = spark.createDataFrame([("ABCDEFGHIJ", 12), ("AB", 2)], "universe string, plen int")
    assert {r["cand"] for r in ops.tuples(domains, max_candidates=1000).collect()} == {"AA", "AB", "BA", "BB"}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = [
        (1, "ABC", 3, sha("ABA"), [sha("BA")]), (2, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123", 2, sha("AB"), [sha("?")]),
        (3, "AB", 60, sha("no"), []), (4, "AB", 2, sha("no"), []), (5, "AAB", 2, sha("BA"), [sha("A")]),
        (6, "AAB", 2, sha("BB"), [sha("B"), sha("B")]),
    ]
    records = spark.createDataFrame(rows, "id int, alphabet string, plen int, value_hash string, hints array<string>")
    got = {r["id"]: (r["value"], r["status"]) for r in ops.recover(records, max_candidates=5000).collect()}
    assert got == {
        1: ("ABA", "found"), 2: (None, "refused"), 3: (None, "refused"), 4: (None, "unresolved"),
        5: (None, "unresolved"), 6: ("BB", "found"),
    }
    matches = ops.match_hints(records, max_candidates=5000).where("id = 6").collect()
    assert sorted((r["hint_ix"], r["excluded"]) for r in matches) == [(1, "A"), (2, "A")]


def test_given_candidates_are_counted_before_they_are_broadcast(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    stored = ops.hashed_permutations(spark.createDataFrame([("ABCDEFG",), ("XYZ",)], "alphabet string"))
    records = spark.createDataFrame(
        [(i, "XYZ", 2, sha("XX"), [sha("XY")] * 30) for i in range(5)],
        "id int, alphabet string, plen int, value_hash string, hints array<string>",
    )
    small = ops.match_hints(records, candidates=stored, broadcast_rows=10)
    assert {r["excluded"] for r in small.collect()} == {"Z"}
    large = spark.createDataFrame([(1, "ABCDEFG", 2, sha("AA"), [sha("ABCDEF")] * 30)], records.schema)
    plan = ops.match_hints(large, candidates=stored, broadcast_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan



def test_empty_input(spark, records):
    nothing = records.where("id < 0")
    assert ops.recover(nothing).collect() == []
    assert ops.match_hints(nothing).collect() == []


def test_stream_matches_without_shuffling_the_candidates(spark, tmp_path):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    stored = f"{tmp_path}/candidates"
    ops.hashed_permutations(spark.createDataFrame([("ABCD",), ("XYZ",)], "alphabet string")).write.parquet(stored)
    candidates = spark.read.parquet(stored)
    schema = "id int, alphabet string, plen int, value_hash string, hints array<string>"
    rows = [(i, "ABCD", 2, sha("AA"), [sha("BCA"), sha("?")]) for i in range(20)] + [(99, "XYZ", 2, sha("XX"), [])]
    records = spark.createDataFrame(rows, schema)
    records.repartition(4).write.parquet(f"{tmp_path}/records")
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/records")
    want = {(i, 1, "D") for i in range(20)} | {(i, 2, None) for i in range(20)}
    for rows_to_broadcast in (1_000_000, 5):
        got = stream_hint_match(stream, candidates, broadcast_rows=rows_to_broadcast)
        assert row_set(got.select("id", "hint_ix", "excluded")) == want
    plan = ops.match_hints(records, candidates=candidates)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


@pytest.mark.parametrize("options", [{}, {"hot_rows": 1}])
@pytest.mark.parametrize("alphabets", [["ABCD", "XYZ", "PQ"], []])
def test_stream_batches_broadcast_nothing(spark, tmp_path, monkeypatch, alphabets, options):
    rows = [(i, "ABCD", 2, sha("AA"), [sha("BCA"), sha("?"), None]) for i in range(12)] + [
        (20, "XYZ", 2, sha("XX"), [sha("ZX"), sha("XY")]),
        (21, "XYZ", 2, sha("XX"), [sha("BCA")]),  # a hint of another alphabet
        (22, None, 2, sha("XX"), [sha("BCA")]),
        (None, "XYZ", 2, sha("XX"), [sha("ZX")]),
        (23, "XYZ", 2, sha("XX"), []),
        (24, "XYZ", 2, sha("XX"), None),
    ]
    records = spark.createDataFrame(rows, "id int, alphabet string, plen int, value_hash string, hints array<string>")
    records.repartition(4).write.parquet(f"{tmp_path}/records")
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/records")
    ops.hashed_permutations(spark.createDataFrame([(a,) for a in alphabets], "alphabet string")).write.parquet(f"{tmp_path}/candidates")
    candidates = spark.read.parquet(f"{tmp_path}/candidates")

    plans, run = [], stream_hints.run_batches

    def traced(stream, label, transform):
        def kept(batch):
            out = transform(batch)
            plans.append((batch.isEmpty(), out._jdf.queryExecution().executedPlan().toString()))
            return out

        return run(stream, label, kept)

    monkeypatch.setattr(stream_hints, "run_batches", traced)
    got = stream_hint_match(stream, candidates, **options)
    want = [(r.id, r.hint_ix, r.hint_hash, r.excluded) for r in ops.match_hints(records, candidates=candidates).collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert len(want) == 24 + 5 and sum(r[3] is not None for r in want) == (12 + 3 if alphabets else 0)
    shuffles = [plan.count("Exchange hashpartitioning") for empty, plan in plans if not empty]
    assert len(shuffles) == 4 and max(shuffles) == (2 if options else 1)
    assert not any("Broadcast" in plan for _, plan in plans)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("latticework_")]


@pytest.mark.parametrize("alphabet", ["A", "BA", "CAB", "DBCAE", "GFEDCBA", "AABAC"])
def test_permutations_by_number(spark, alphabet):
    symbols = list(dict.fromkeys(alphabet))
    everything = list(itertools.permutations(symbols))
    n = len(everything)
    asked = [(0, 0), (n // 3, 2 * n // 3), (n - 1, n + 5), (-4, 1), (n, n + 9), (3, 2)]
    df = spark.createDataFrame([(alphabet, *r) for r in asked], "alphabet string, first bigint, last bigint")
    want = sorted(
        (alphabet, i, "".join(everything[i][:-1]), everything[i][-1])
        for first, last in asked
        for i in range(max(first, 0), min(last, n - 1) + 1)
    )
    assert sorted(tuple(r) for r in ops.permutations_between(df).collect()) == want


def test_permutations_by_number_of_long_and_missing_alphabets(spark):
    long = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    twenty = long[:20]
    rows = [(long, 0, 1), (twenty, math.factorial(20) - 2, math.factorial(20) - 1), (None, 0, 5), ("AB", None, 1), ("AB", 0, None)]
    df = spark.createDataFrame(rows, "alphabet string, first bigint, last bigint")
    got = {(r.alphabet, r.number): r.cand + r.excluded for r in ops.permutations_between(df).collect()}
    back = twenty[::-1]
    assert got == {
        (long, 0): long,
        (long, 1): long[:24] + "ZY",
        (twenty, math.factorial(20) - 2): back[:18] + "AB",
        (twenty, math.factorial(20) - 1): back,
    }


def test_strings_by_number(spark):
    asked = [("AB", 3, 2, 6), ("XYZ", 2, 0, 8), ("Q", 4, 0, 0), ("AB", 0, 0, 0)]
    df = spark.createDataFrame(asked, "universe string, plen int, first bigint, last bigint")
    want = {
        (u, n, i, "".join(list(itertools.product(u, repeat=n))[i])) for u, n, first, last in asked for i in range(first, last + 1)
    }
    assert row_set(ops.strings_between(df, 16)) == want


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_slices_give_what_recover_gives(spark, records, broadcast_rows):
    got = ops.recover_in_slices(records, first_slice=3, growth=2, broadcast_rows=broadcast_rows).collect()
    assert {r.id: r.value for r in got} == EXPECTED
    assert {r.id for r in got if r.status == "unresolved"} == {1, 7}
    assert all((r.slice is None) == (r.value is None) for r in got)


def test_a_domain_ends_with_its_last_open_record(spark):
    rows = [
        (1, "ABCD", 3, sha("AAA"), []),  # number 0
        (2, "ABCD", 3, sha("AAC"), []),  # number 2: the second slice of two
        (3, "ABCD", 2, sha("DD"), []),  # number 15 of 16
        (4, "AB", 2, sha("no such"), []),
        (5, "AB", 30, sha("too many"), []),
        (6, "ABC", 2, None, []),  # nothing to look for
        (7, "ABCD", 3, sha("AAA"), []),
    ]
    df = spark.createDataFrame(rows, "id bigint, alphabet string, plen int, value_hash string, hints array<string>")
    got = row_set(ops.recover_in_slices(df, max_candidates=1_000, first_slice=2, growth=2))
    assert got == {
        (1, "AAA", "found", 1, 2),
        (2, "AAC", "found", 2, 2),
        (3, "DD", "found", 4, 4),
        (4, None, "unresolved", None, 2),
        (5, None, "refused", None, 0),
        (6, None, "unresolved", None, 0),
        (7, "AAA", "found", 1, 2),
    }


def test_slices_of_no_records(spark, records):
    assert ops.recover_in_slices(records.limit(0)).count() == 0
