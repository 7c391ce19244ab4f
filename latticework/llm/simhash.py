"""SimHash near-duplicates: pigeonhole blocks propose pairs, the Hamming distance decides."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticework.llm.components import connected_components
from latticework.llm.text import as_bytes, parts, smaller_batches
from latticework.operators.joins import lookup
from latticework.session import materialize

SHINGLE_WORDS, SEED, DISTANCE, BITS = 4, 42, 4, 64
# Fingerprints of one bucket that one call compares; a larger bucket is dealt in chunks.
CHUNK = 1 << 15


def shingle_hashes(data: bytes, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of ``width`` words, repeats included; of all words if there are fewer."""
    digest, carried, any_yet = xxhash.xxh64_intdigest, [], False
    for part in parts(data):
        words = carried + part.split()
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
            yield np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
            any_yet = True
            carried = words[len(words) - width + 1 :]
        else:
            carried = words
    if carried and not any_yet:
        yield np.array([digest(b" ".join(carried), SEED)], np.uint64)


def fingerprint(data: bytes | None) -> int:
    """Bit by bit the majority of the shingles' hashes; zero without words."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes((data or b"").lower()):
        for at in range(0, len(hashes), 1 << 15):
            some = hashes[at : at + (1 << 15)]
            bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    ones = np.packbits(2 * counts > n, bitorder="little")
    return int(ones.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in smaller_batches(batches, "text"):
        found = [fingerprint(data) for data in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], ["id", "fp"])


def masks_for(n: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks such that two fingerprints within ``distance`` agree under at least one.

    The bits are cut in ``distance + k`` blocks, of which any such pair shares ``k``; the masks are
    all choices of ``k`` blocks. ``k`` grows until a random bucket of ``n`` fingerprints holds few, which
    changes the work and never the result.
    """
    k = 1
    while True:
        n_blocks = distance + k
        borders = [BITS * i // n_blocks for i in range(n_blocks + 1)]
        shared = k * (BITS // n_blocks)
        if (1 << shared) * 2 >= n or k == 6:
            break
        k += 1
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(borders, borders[1:])]
    return [sum(chosen) for chosen in combinations(blocks, k)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _tree(fps: np.ndarray, ids: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what is within ``distance``, at most one fewer than members.

    Searches from one member at a time through those not yet reached.
    """
    found, open_fps, open_ids = [], fps, ids
    while len(open_fps) > 1:
        queue = [(open_fps[0], open_ids[0])]
        open_fps, open_ids = open_fps[1:], open_ids[1:]
        while queue and len(open_fps):
            fp, node = queue.pop()
            near = np.bitwise_count(open_fps ^ fp) <= distance
            if near.any():
                hit_fps, hit_ids = open_fps[near], open_ids[near]
                found.extend((node, other) for other in hit_ids)
                queue.extend(zip(hit_fps, hit_ids))
                open_fps, open_ids = open_fps[~near], open_ids[~near]
    return found


def _bucket_links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; a bucket may go on in the next batch."""
        names, held = ("mask_no", "bucket", "part", "fp", "id"), None

        def linked(cols):
            new = np.ones(len(cols[0]), bool)
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(new)))
            fps, ids = cols[3].view(np.uint64), cols[4]
            two = starts[sizes == 2]
            near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
            links = list(zip(ids[near], ids[near + 1]))
            for at, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                links.extend(_tree(fps[at : at + n], ids[at : at + n], distance))
            a, b = np.array(links, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            cols = [np.asarray(batch.column(name)) for name in names]
            if not batch.num_rows:
                continue
            if held is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(held, cols)]
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            held = [x[last] for x in cols]
            if not last.all():
                yield linked([x[~last] for x in cols])
        if held is not None:
            yield linked(held)

    return run


def links(classes: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) between the classes (id, fp) that join all within ``distance`` bits.

    ``fp`` must be distinct. Classes meet in the buckets of ``masks_for``. A bucket yields a spanning
    forest, never its pairs. A bucket of more than ``chunk`` members is dealt in chunks, and each
    pair of chunks is one call, so that no group is gathered whole.
    """
    masks = masks_for(classes.count(), distance)
    keyed = classes.select(
        "id",
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("mask_no"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"))
                    for i, m in enumerate(masks)
                )
            )
        ).alias("key"),
    ).select("key.*", "fp", "id")
    large = (
        keyed.groupBy("mask_no", "bucket")
        .agg(F.count("*").alias("members"))
        .where(F.col("members") > 1)
        .withColumn("chunks", F.ceil(F.col("members") / chunk).cast("int"))
        .select("mask_no", "bucket", "chunks")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    dealt = (
        lookup(keyed, large, ["mask_no", "bucket"], "inner")
        .select("mask_no", "bucket", "chunks", "fp", "id", own.alias("own"), other)
        .select(
            "mask_no",
            "bucket",
            (F.least("own", "other").cast("long") * F.col("chunks") + F.greatest("own", "other")).alias("part"),
            "fp",
            "id",
        )
    )
    keys = ["mask_no", "bucket", "part"]
    return (
        dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_bucket_links(distance), "a long, b long")
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """(id, fp, component) of each row of ``docs``; ``fp`` is the signed fingerprint.

    Texts lose the case of A-Z and are read whole. Equal fingerprints are one class from the start, so
    copies never meet in pairs; classes link at ``distance`` or fewer differing bits; the component is
    the smallest id reachable. Null and empty texts have fingerprint zero, which links like any
    other. Repeated rows are kept, with equal results. A row without id keeps its fingerprint and gets
    the component of its class, null if no row of the class has an id. Other columns are not read.
    No rows: no rows.
    """
    prints = materialize(
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
            _fingerprints, "id long, fp long"
        ),
        "simhash",
    )
    classes = materialize(
        prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")), "simhash-classes"
    )
    found = connected_components(links(classes, distance), "simhash-links")
    named = classes.join(found, classes["id"] == found["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component")
    )
    return lookup(prints, named, ["fp"], "left").select("id", "fp", "component")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest id.

    All columns stay. Of rows with the same id and text one stays; different texts under the id that is kept all stay,
    since the id does not tell which is meant. Rows without id all stay.
    """
    keepers = (
        near_duplicates(docs, id, text, distance)
        .where("id = component")
        .select(F.col("id").alias(id))
        .distinct()
    )
    kept = docs.join(keepers, id, "left_semi").dropDuplicates([id, text])
    return kept.unionByName(docs.where(F.col(id).isNull()))
