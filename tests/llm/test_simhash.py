import random
import re

import xxhash

from latticework.llm import simhash

SCHEMA = "doc_id long, text string"


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows, distance=4):
    prints = {i: brute_print(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, prints[i], find(i)) for i in ids}


def texts(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 60, 200]))]
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            if rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = "CHANGED"
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(copy)))
    return rows + [(len(rows) + k, t) for k, t in enumerate(["", None, "one", "ÄÖ Wort", "  \n"])]


def test_matches_brute_force(spark):
    rows = texts()
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.id, r.fp % (1 << 64), r.component) for r in got} == brute(rows)


def test_chunks_of_a_large_bucket_lose_no_link(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(63) & ~0xFFF for _ in range(3)}
    fps = sorted({f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps for _ in range(60)})
    rows = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in enumerate(fps)]
    classes = spark.createDataFrame(rows, "id long, fp long")

    def groups(chunk):
        found = simhash.links(classes, chunk=chunk).collect()
        root = {i: i for i, _ in rows}
        for r in found:
            a, b = root[r.a], root[r.b]
            root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
        return root

    whole = groups(1 << 15)
    assert groups(7) == whole
    exact = {i: i for i, _ in rows}
    for i, f in enumerate(fps):
        for j, g in enumerate(fps[:i]):
            if (f ^ g).bit_count() <= 4:
                a, b = exact[i], exact[j]
                exact = {k: min(a, b) if v in (a, b) else v for k, v in exact.items()}
    assert whole == exact


def test_every_close_pair_shares_a_mask():
    rng = random.Random(5)
    for n in (10, 10**5, 10**7, 10**9):
        masks = simhash.masks_for(n)
        for _ in range(300):
            fp, other = (x := rng.getrandbits(64)), x
            for bit in rng.sample(range(64), 4):
                other ^= 1 << bit
            assert any(fp & m == other & m for m in masks)


def test_edge_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    rows = [(5, "a b c d e", "x"), (5, "a b c d e", "x"), (None, "a b c d e", "y"), (2, None, None), (1, "", "z")]
    docs = spark.createDataFrame(rows, SCHEMA + ", fp string")
    got = sorted((r.id or -1, r.component) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, 5), (1, 1), (2, 1), (5, 5), (5, 5)]
    kept = simhash.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 5]


def test_very_long_text(spark):
    text = " ".join(f"w{i % 977}" for i in range(400_000))
    got = simhash.near_duplicates(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert got.fp % (1 << 64) == brute_print(text)
