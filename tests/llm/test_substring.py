import random
import re

import pytest

from latticework.llm import substring

SCHEMA = "doc_id long, text string"


def brute(rows, window=50):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for p in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[p : p + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1 if i is not None else 0):
            if least[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def test_cover_holds_every_difference():
    d = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert d == set(range(substring.PERIOD))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_bytes", [1 << 23, 3000])
def test_matches_brute_force(spark, seed, block_bytes):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["ä.", "x y"]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (49, 50, 51, 70, 130, 300)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 3)
            words += p[a : len(p) - rng.randrange(len(p) // 3)] if rng.random() < 0.4 else p
        rows.append((i * 7 % 60, rng.choice([" ", "\n\t "]).join(words)))
    rows += [(100, "a " * 120), (101, "a " * 90), (102, ""), (103, None), (7, rows[0][1]), (None, rows[3][1])]
    got = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA), block_bytes=block_bytes)
    assert result(got) == brute(rows)


def test_rows_of_one_id_are_spread(spark):
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(80)]
    rows = [(5, " ".join([f"a{i}", *shared, f"b{i}", *(f"w{rng.randrange(50)}" for _ in range(60))])) for i in range(60)]
    rows += [(9, " ".join(shared)), (2, " ".join(shared[10:])), (5, rows[0][1]), (None, rows[1][1])]
    seen = []
    numbered = substring.block_number

    def spy(key, n_blocks):
        seen.append((key, n_blocks))
        return numbered(key, n_blocks)

    docs = spark.createDataFrame(rows, SCHEMA)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(substring, "block_number", spy)
        got = result(substring.remove_repeats(docs, block_bytes=2000))
    assert got == brute(rows)
    assert docs.where("doc_id = 5").select(numbered(*seen[0])).distinct().count() > 5


def test_other_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 5, None), (2, None, 6, "k")], SCHEMA + ", n_words int, hash string")
    got = substring.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "hash", "n_words", "n_removed", "kept_text"]
    assert sorted(map(tuple, got.collect())) == [(1, "a b", None, 2, 0, "a b"), (2, None, "k", 0, 0, "")]
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_names_in_any_case_and_of_the_block(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x", "y")], SCHEMA + ", N_Words int, __block string, block string")
    got = substring.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "__block", "block", "n_words", "n_removed", "kept_text"]
    assert tuple(got.first()) == (1, "a b", "x", "y", 2, 0, "a b")


def test_very_long_text(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(300_000))
    got = result(substring.remove_repeats(spark.createDataFrame([(1, text), (2, "x " + text)], SCHEMA)))
    assert got == [(1, 300_000, 0, text), (2, 300_001, 300_000, "x")]
