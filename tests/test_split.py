import pytest

from latticework.operators.split import even_split, global_rank, range_borders


@pytest.mark.parametrize("n,ranges", [(100, 7), (3, 7), (7, 7), (1, 3), (1_000, 1), (999, 10)])
def test_even_split_is_ntile(spark, n, ranges):
    df = spark.range(n).selectExpr("id * 37 % 1009 as k", "id").repartition(5)
    got = even_split(df, ["k", "id"], ranges).collect()
    order = sorted((r["k"], r["id"]) for r in got)
    want = {}
    at = 0
    for number in range(ranges):
        size = n // ranges + (number < n % ranges)
        want.update({key: number + 1 for key in order[at:at + size]})
        at += size
    assert {(r["k"], r["id"]): r["range_no"] for r in got} == want and len(got) == n


def test_hot_key_with_a_tie_breaker(spark):
    df = spark.range(600).selectExpr("if(id % 3 = 0, 5, id) as k", "id")
    ranks = {(r["k"], r["id"]): r["rank"] for r in global_rank(df, ["k", "id"]).collect()}
    assert [key for key, _ in sorted(ranks.items(), key=lambda e: e[1])] == sorted(ranks)
    assert sorted(ranks.values()) == list(range(600))


def test_ties_are_broken_by_the_other_columns(spark):
    df = spark.range(300, numPartitions=6).selectExpr("1 as k", "id", "map(id, id) as m")
    ranks = {r["id"]: r["rank"] for r in global_rank(df, ["k"]).collect()}
    assert ranks == {i: i for i in range(300)}


def test_borders(spark):
    borders = range_borders(even_split(spark.range(10), ["id"], 3), "id")
    rows = sorted(tuple(r) for r in borders.collect())
    assert rows == [(1, 0, 3, 4), (2, 4, 6, 3), (3, 7, 9, 3)]


def test_empty_table_and_bad_argument(spark):
    assert even_split(spark.range(0), ["id"], 4).count() == 0
    with pytest.raises(ValueError):
        even_split(spark.range(3), ["id"], 0)
