"""Substring deduplication: anchors at the positions of a difference cover, then whole windows."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.llm.text import Windows, as_bytes, block_number, count_blocks, covered, hasher, parts, release, word_hashes
from latticework.operators.joins import fresh

# For any two positions some shift below PERIOD brings both into COVER modulo PERIOD: the differences of
# these six numbers are all residues of 31.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
BLOCK_BYTES = 8 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Block:
    """Words of all documents of a block in one array."""

    def __init__(self, docs: pa.Table, id: str, text: str):
        known = hasher()
        self.data = as_bytes(docs.column(text))
        each = [word_hashes(data or b"", known) for data in self.data]
        self.sizes = np.fromiter(map(len, each), np.int64, len(each))
        self.words = np.concatenate(each) if each else np.empty(0, np.uint64)
        ids = docs.column(id)
        named = np.asarray(ids.is_valid())
        self.doc_ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.at = np.arange(len(self.words), dtype=np.int32) - np.repeat((self.ends - self.sizes).astype(np.int32), self.sizes)
        # Words from here to the end; a document without id is neither cut nor evidence.
        self.left = np.repeat(np.where(named, self.sizes, 0).astype(np.int32), self.sizes) - self.at

    def starts(self, width: int) -> np.ndarray:
        """Whether a window of ``width`` words of one document starts here."""
        return self.left >= width

    def ids(self, at: np.ndarray) -> np.ndarray:
        """The documents of the words at ``at``."""
        return self.doc_ids[np.searchsorted(self.ends, at, side="right")]

    def anchors(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows of ``width`` words at cover positions."""
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        at = np.flatnonzero(cover[self.at % PERIOD] & self.starts(width))
        return at, Windows(0xD1B54A32D192ED03).of(self.words, width)[at]

    def windows(self, width: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the windows at ``at``, 96 bits together."""
        other = (self.words ^ (self.words >> np.uint64(32))) * _MIX
        return (
            Windows(0xA0761D6478BD642F).of(self.words, width)[at],
            (Windows(0xE7037ED1A0B428DB).of(other, width)[at] >> np.uint64(32)).astype(np.uint32),
        )


def _anchor_rows(id: str, text: str, width: int):
    def run(key, docs):
        block = _Block(docs, id, text)
        at, hashes = block.anchors(width)
        ids = block.ids(at)
        order = np.argsort(hashes, kind="stable")
        hashes, ids = hashes[order], ids[order]
        del block, order
        firsts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        several = np.zeros(0, np.int64)
        if len(firsts):
            several = (np.minimum.reduceat(ids, firsts) != np.maximum.reduceat(ids, firsts)).astype(np.int64)
        found = pa.table({"hash": hashes[firsts].view(np.int64), "code": 2 * key[0].as_py() + several})
        del hashes, ids, firsts, several
        release()
        return found

    return run


def _window_rows(id: str, text: str, window: int, width: int):
    def run(key, docs, shared):
        block = _Block(docs, id, text)
        at, hashes = block.anchors(width)
        hit = at[np.isin(hashes, np.asarray(shared.column("hash")).view(np.uint64))]
        steps = np.zeros(len(block.words) + 1, np.int64)
        np.add.at(steps, np.maximum(hit - (window - width), 0), 1)
        np.add.at(steps, hit + 1, -1)
        near = np.flatnonzero((np.cumsum(steps[:-1]) > 0) & block.starts(window))
        one, two = block.windows(window, near)
        ids = block.ids(near)
        del block, steps
        order = np.lexsort((two, one))
        one, two, ids = one[order], two[order], ids[order]
        new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(one)]
        firsts = np.flatnonzero(new)
        least, most = (f.reduceat(ids, firsts) if len(firsts) else ids for f in (np.minimum, np.maximum))
        found = pa.table(
            {
                "one": one[firsts].view(np.int64),
                "two": two[firsts].view(np.int32),
                "least": least,
                "span": most - least,
                "block": np.full(len(firsts), key[0].as_py(), np.int32),
            }
        )
        del one, two, ids, order, new, firsts, least, most, at, hashes, near, hit
        release()
        return found

    return run


def _repeated(block: _Block, window: int, verdicts: pa.Table) -> np.ndarray:
    """Starts of the windows that also start in a document of a smaller id."""
    one = np.asarray(verdicts.column("one")).view(np.uint64)
    two = np.asarray(verdicts.column("two")).view(np.uint32)
    least = np.asarray(verdicts.column("least"))
    order = np.lexsort((two, one))
    one, two, least = one[order], two[order], least[order]
    at = np.flatnonzero(block.starts(window))
    found = []
    if len(one) and len(at):
        first, second = block.windows(window, at)
        place = np.searchsorted(one, first)
        while len(at):
            inside = place < len(one)
            inside[inside] = one[place[inside]] == first[inside]
            at, first, second, place = (x[inside] for x in (at, first, second, place))
            same = two[place] == second
            found.append(at[same][least[place[same]] < block.ids(at[same])])
            place = place + 1
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _kept(id: str, text: str, window: int, names: list[str]):
    def run(key, docs, verdicts):
        block = _Block(docs, id, text)
        gone = covered(_repeated(block, window, verdicts), window, len(block.words))
        texts, removed, at = [], [], 0
        for data, size in zip(block.data, block.sizes.tolist()):
            keep, kept, done = ~gone[at : at + size], [], 0
            for part in parts(data or b""):
                words = part.split()
                kept.extend(compress(words, keep[done : done + len(words)].tolist()))
                done += len(words)
            texts.append(b" ".join(kept))
            removed.append(size - int(keep.sum()))
            at += size
        out = {name: docs.column(name) for name in docs.column_names}
        out |= {
            "n_words": pa.array(block.sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        }
        del block, gone, texts
        release()
        return pa.table({name: out[name] for name in names})

    return run


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 50, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text: each word is removed that a window of ``window``
    words covers which also starts in a document of a smaller id.

    Windows are judged on the input. Any two equal windows hold an equal anchor of ``window - 30`` words
    at an aligned cover position, so only windows around an anchor that two documents share are hashed
    whole; their 96-bit hashes decide. Work meets by blocks of documents: a block sends each hash
    once, with the smallest and largest id, so a passage that fills a third of the corpus is one row
    a block.

    ``kept_text`` joins what stays by one space; a null or empty text keeps the empty text. Rows without
    id lose nothing and prove nothing. Rows of one id do not remove each other and are spread over blocks by
    their texts; rows of one id and text share a block. Other columns
    stay, whatever their names; those named n_words, n_removed or kept_text, in any case, are replaced. No rows: no rows.
    """
    width = window - PERIOD + 1
    if width < 1:
        raise ValueError(f"windows need {PERIOD} words at least")
    names = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "kept_text")]
    block = fresh("block", names)
    n_blocks = count_blocks(docs, text, block_bytes)
    blocked = docs.select(*names).withColumn(id, F.col(id).cast("long"))
    # By id and text, so that rows of one id or without id, however many, are spread.
    blocked = blocked.withColumn(block, block_number(F.xxhash64(id, text), n_blocks))
    groups = blocked.groupBy(block)

    anchors = groups.applyInArrow(_anchor_rows(id, text, width), "hash long, code long")
    shared = (
        anchors.withColumn("blocks", F.count("*").over(Window.partitionBy("hash")))
        .where("blocks > 1 OR code % 2 = 1")
        .select(F.shiftright("code", 1).cast("int").alias(block), "hash")
    )
    rows = groups.cogroup(shared.groupBy(block)).applyInArrow(
        _window_rows(id, text, window, width), "one long, two int, least long, span long, block int"
    )
    verdicts = (
        rows.withColumn("first", F.min("least").over(Window.partitionBy("one", "two")))
        .where("least + span > first")
        .select(F.col("block").alias(block), "one", "two", F.col("first").alias("least"))
    )
    schema = T.StructType(
        [f for f in blocked.schema.fields if f.name != block]
        + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
        + [T.StructField("kept_text", T.StringType())]
    )
    return groups.cogroup(verdicts.groupBy(block)).applyInArrow(_kept(id, text, window, schema.names), schema)
