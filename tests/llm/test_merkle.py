import hashlib
import random

import pytest
from pyspark.sql import functions as F

from latticework.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def path(levels, at):
    found = []
    for level in levels[:-1]:
        run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(level)))
        found.append(("".join(level[i] for i in run if i < at), "".join(level[i] for i in run if i > at)))
        at //= 3
    return found


def brute(rows, claims=lambda row: row):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(tree([leaf(r) for r in groups[name]]))
    upper = tree([levels[-1][0] for levels in trees])
    out = []
    for g, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            siblings = path(trees[g], at) + path(upper, g)
            folded = leaf(claims(row))
            for left, right in siblings:
                folded = digest(left, folded, right)
            proof = digest(*(left + right for left, right in siblings))
            out.append((row[0], leaf(row), trees[g][-1][0], upper[-1][0], proof, folded))
    return sorted(out, key=repr)


def made(seed, n):
    rng = random.Random(seed)
    sources = ["hot"] * 12 + ["b", "ä", "z", "", None, "Z", "hot2"]
    rows = [
        (rng.choice([i, i, 7, None]), rng.choice([None, "", "a\nb", f"t{i} é\n", "\n"]), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, i]))
        for i in range(n)
    ]
    return rows + rows[:5] + [rows[0]] * 4


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("n, levels", [(1, 1), (60, 1), (400, 2), (400, 8)])
def test_proofs_equal_brute_force(spark, n, levels):
    rows = made(n, n)
    leaves = merkle.document_leaves(spark.createDataFrame(rows, SCHEMA)).withColumn("claimed", F.col("digest"))
    tables = merkle.manifest(leaves, levels=levels)
    want = brute(rows)
    assert found(merkle.prove(tables, levels=levels)) == want
    assert all(row[3] == row[5] for row in want)
    # Some leaves alone: more nodes are fetched, and the proofs are the same.
    some = tables["leaves"].where("ix % 5 = 2")
    few = found(merkle.prove(tables, some, levels=levels))
    assert set(few) <= set(want) and len(few) == some.count()


def test_tampered_rows_are_found(spark):
    import zlib

    rows = made(9, 200)

    def claims(row):
        even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        return row if not even or row[1] is None else (row[0], row[1].replace("\n", ""), *row[2:])

    tables = merkle.manifest(merkle.document_leaves(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows, claims)
    assert found(merkle.prove(tables)) == want
    assert 0 < sum(row[3] != row[5] for row in want) < len(want)


@pytest.mark.parametrize("seed", range(5))
def test_the_fewest_nodes_are_fetched(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 200)
    digests = [digest(str(i)) for i in range(n)]
    levels = tree(digests)
    leaves = set(rng.sample(range(n), rng.randrange(1, n + 1)))
    coordinates = merkle.missing(leaves, n)
    paths = merkle.Paths(n, {(level, ix): levels[level][ix] for level, ix in coordinates})
    paths.derive({ix: digests[ix] for ix in leaves})
    assert paths.root() == levels[-1][0]
    for ix in leaves:
        assert paths.siblings(ix) == path(levels, ix)
        assert merkle.fold(digests[ix], paths.siblings(ix)) == levels[-1][0]
    # None of them holds one of the leaves below, and each parent of one does: none can go.
    for level, ix in coordinates:
        below = lambda k, i: any(leaf // 3**k == i for leaf in leaves)
        assert not below(level, ix) and below(level + 1, ix // 3)
    assert len(set(coordinates)) == len(coordinates)


def test_no_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.prove(merkle.manifest(merkle.document_leaves(docs))).collect() == []
    one = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    one = one.withColumns({c: F.lit("x") for c in ("id", "grp", "digest", "claimed", "ix", "n", "block", "spread")})
    want = digest("1:1", "-", "-", "-", "-")
    assert found(merkle.prove(merkle.manifest(merkle.document_leaves(one)))) == [(1, want, want, want, digest(), want)]
