"""Benchmark decontamination: texts are streamed through a generalised suffix automaton of the test items."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latticework.llm.text import as_bytes, smaller_batches
from latticework.session import materialize

WINDOW = 10
# Texts of items that one automaton holds; more items make more automata, each text is streamed through all of them.
SHARD_BYTES = 1 << 20
# Documents with a larger share of hit words go as a whole.
MOST_COVERAGE = 0.5

# Words are runs of ASCII letters and digits and of all characters beyond ASCII, in lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)

SCANNED = "n_words bigint, hits binary, items array<string>"


def normalised(data: bytes | None) -> bytes:
    """The text with A-Z in lower case and every separator as a space, byte for byte."""
    return (data or b"").translate(_WORD_BYTES)


class Automaton:
    """Generalised suffix automaton of word sequences; state 0 is the empty sequence.

    ``items`` are (name, normalised text) pairs; a window is ``window`` consecutive words of one, or a shorter
    one as a whole. An item without words has none.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        texts = [(name, [self.words.setdefault(w, len(self.words)) for w in text.split()]) for name, text in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, numbers in texts:
            last = 0
            for number in numbers:
                last = self._extend(last, number)
        # Names by state: of the items that hold the state's sequences, and of the short items that end there.
        self.holders: list[set[str]] = [set() for _ in self.next]
        self.whole: list[dict[int, set[str | None]]] = [{} for _ in self.next]
        for name, numbers in texts:
            if len(numbers) < window:
                if numbers:
                    state = functools.reduce(lambda s, w: self.next[s][w], numbers, 0)
                    self.whole[state].setdefault(len(numbers), set()).add(name)
                continue
            if name is not None:
                self._mark(name, numbers)
        self.shortest = self._shortest()
        self.found: dict[tuple[int, int], frozenset[str]] = {}

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, number: int, below: int) -> int:
        """A state of the sequences of ``below`` that end the way of ``state`` and ``number``."""
        copy = self._state(self.length[state] + 1, dict(self.next[below]), self.link[below])
        self.link[below] = copy
        while state >= 0 and self.next[state].get(number) == below:
            self.next[state][number] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, number: int) -> int:
        known = self.next[last].get(number)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, number, known)
        new, state = self._state(self.length[last] + 1, {}, 0), last
        while state >= 0 and number not in self.next[state]:
            self.next[state][number] = new
            state = self.link[state]
        if state >= 0:
            below = self.next[state][number]
            right = self.length[below] == self.length[state] + 1
            self.link[new] = below if right else self._split(state, number, below)
        return new

    def _mark(self, name: str, numbers: list[int]) -> None:
        """Adds ``name`` to the states of the item's sequences of ``window`` words and more."""
        state = 0
        for number in numbers:
            state = up = self.next[state][number]
            while self.length[up] >= self.window and name not in self.holders[up]:
                self.holders[up].add(name)
                up = self.link[up]

    def _shortest(self) -> np.ndarray:
        """By state, the words of the shortest short item that ends its sequences."""
        none = np.iinfo(np.int64).max
        found = [none] * len(self.next)
        for state in np.argsort(self.length, kind="stable").tolist():
            above = found[self.link[state]] if state else none
            found[state] = min(above, *self.whole[state], none)
        return np.array(found, np.int64)

    def walk(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """After each word, the state and the length of the longest match that ends there."""
        following, link, lengths = self.next, self.link, self.length
        states, matched, state, length = [], [], 0, 0
        for number in numbers:
            to = following[state].get(number)
            while to is None and state:
                state = link[state]
                length = lengths[state]
                to = following[state].get(number)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            states.append(state)
            matched.append(length)
        return np.array(states, np.int64), np.array(matched, np.int64)

    def names(self, state: int, length: int) -> tuple[frozenset[str], tuple[int, ...]]:
        """The items with a window that ends a match, and the words of the windows that end it."""
        key = (state, min(length, self.length[state]))
        known = self.found.get(key)
        if known is None:
            names, sizes, at = set(), [], state
            while at > 0:
                for size, whole in self.whole[at].items():
                    if size <= length:
                        names |= whole
                        sizes.append(size)
                if self.length[self.link[at]] < self.window <= min(length, self.length[at]):
                    names |= self.holders[at]
                    sizes.append(self.window)
                at = self.link[at]
            known = self.found[key] = frozenset(names - {None}), tuple(sizes)
        return known

    def scan(self, data: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Words of a normalised text, which of them windows cover, and the items of these windows."""
        words = data.split()
        n = len(words)
        numbers = [self.words.get(word, -1) for word in words]
        known = np.fromiter(numbers, np.int64, n) >= 0
        steps, items = np.zeros(n + 1, np.int64), set()
        # A word that no item has ends every match, so stretches of known words are streamed one by one.
        turns = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        least = min(self.window, int(self.shortest.min()))
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if end - start < least:
                continue
            states, matched = self.walk(numbers[start:end])
            for at in np.flatnonzero((matched >= self.window) | (matched >= self.shortest[states])).tolist():
                names, sizes = self.names(int(states[at]), int(matched[at]))
                items |= names
                if sizes:
                    steps[start + at + 1 - max(sizes)] += 1
                    steps[start + at + 1] -= 1
        return n, np.cumsum(steps[:n]) > 0, items


@functools.lru_cache(maxsize=2)
def automaton(items: tuple, window: int) -> Automaton:
    """One automaton a Python worker, shard and window."""
    return Automaton(list(items), window)


def _scan(items: tuple, window: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(items, window)
        for batch in smaller_batches(batches, "text"):
            counts, hits, names = [], [], []
            earlier = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())
            for data, (hit_before, names_before) in zip(as_bytes(batch.column("text")), earlier):
                n, hit, found = machine.scan(normalised(data))
                if hit_before:
                    hit |= np.unpackbits(np.frombuffer(hit_before, np.uint8), count=n).astype(bool)
                counts.append(n)
                hits.append(np.packbits(hit).tobytes() if hit.any() else b"")
                names.append(sorted(found.union(names_before)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(counts, pa.int64()),
                    pa.array(hits, pa.binary()),
                    pa.array(names, pa.list_(pa.string())),
                ],
                [*kept, "n_words", "hits", "items"],
            )

    return run


def shards(items: DataFrame, item_id: str, text: str, shard_bytes: int) -> Iterator[tuple]:
    """The items' names and normalised texts, in parts of at most ``shard_bytes`` of text, or little more than one item.

    The parts follow from a running sum in buckets of the items; each is sent to the driver when it is its turn.
    Equal rows are sent once. There is one part at least, which may be empty.
    """
    rows = items.select(F.col(item_id).cast("string").alias("name"), F.col(text).cast("string").alias("text"))
    rows = rows.where(F.octet_length("text") > 0).distinct()
    size = F.octet_length("text").cast("long")
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    if total <= shard_bytes:
        parts = [rows]
    else:
        # Buckets by a hash, small beside a part, are joined to parts; a bucket that is larger is dealt by its rows.
        n = max(1, -(-4 * total // shard_bytes))
        rows = materialize(rows.withColumn("bucket", F.pmod(F.xxhash64("name", "text"), F.lit(n))), "benchmark")
        upto = Window.partitionBy("bucket").orderBy("name", "text").rowsBetween(Window.unboundedPreceding, 0)
        inner = F.floor((F.sum(size).over(upto) - size) / F.lit(max(1, shard_bytes // 4)))
        rows = materialize(rows.withColumn("part", inner), "benchmark")
        sizes = rows.groupBy("bucket", "part").agg(F.sum(size).alias("n")).orderBy("bucket", "part").collect()
        parts, chosen, held = [], [], 0
        for bucket, part, n_bytes in (*sizes, (None, None, shard_bytes + 1)):
            if chosen and held + n_bytes > shard_bytes:
                wanted = functools.reduce(lambda a, b: a | b, ((F.col("bucket") == x) & (F.col("part") == y) for x, y in chosen))
                parts.append(rows.where(wanted))
                chosen, held = [], 0
            chosen.append((bucket, part))
            held += n_bytes
    for part in parts:
        found = sorted(((r["name"], normalised(r["text"].encode())) for r in part.collect()), key=repr)
        yield tuple((name, text) for name, text in found if text.split())


def scan(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    with_text: bool = True,
) -> DataFrame:
    """(id, text, n_words, hits, items) of each row of ``docs``, the text unless ``with_text`` is false.

    Texts and items have A-Z in lower case; words are runs of ASCII letters, digits and characters beyond
    ASCII. Windows are ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A word of a document is hit if an occurrence of a window covers it: bit i of ``hits``, from the
    highest of the first byte, is word i; empty if none is hit. ``items`` are the distinct names of the items with such windows,
    as text in ascending order.

    Each automaton holds at most ``shard_bytes`` of items and is built in the tasks; texts are streamed through
    them without a shuffle, one pass a shard, and an earlier pass's hits go along. Between shards
    the rows are stored.

    A null or empty text has no words. Null ids and repeated rows keep their rows. An item without id hits words
    and is not named; repeated ids are one item with the windows of all their texts. No items: no
    hits. Other columns are not read, whatever their names. No rows: no rows.
    """
    found = docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.lit(b"").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    parts = shards(items, item_id, item_text, shard_bytes)
    shard = next(parts)
    while True:
        following = next(parts, None)
        kept = ["id", "text"] if with_text or following is not None else ["id"]
        fields = f"id long, text string, {SCANNED}" if len(kept) == 2 else f"id long, {SCANNED}"
        found = found.mapInArrow(_scan(shard, window, kept), fields)
        if following is None:
            return found
        found, shard = materialize(found, "decontaminate"), following


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = [int.from_bytes(bits).bit_count() for bits in batch.column("hits").to_pylist()]
        columns = [batch.column("id"), batch.column("n_words"), pa.array(hit, pa.int64()), batch.column("items")]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_hit", "items"])


def contamination(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """(id, n_words, n_hit, items) of each row, by ``scan``."""
    found = scan(docs, items, with_text=False, **settings)
    return found.mapInArrow(_measure, "id long, n_words long, n_hit long, items array<string>")


def _clean(most_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, "text"):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("id", "n_words", "hits"))
            for doc_id, n, bits, data in zip(*columns, as_bytes(batch.column("text"))):
                if not bits:
                    rows.append((doc_id, data, n, 0))
                    continue
                hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
                n_hit = int(hit.sum())
                if n_hit > most_coverage * n:
                    continue
                rows.append((doc_id, _without(data, hit), n, n_hit))
            kinds = [("id", pa.int64()), ("text", pa.binary()), ("n_words", pa.int64()), ("n_hit", pa.int64())]
            made = [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)]
            made[1] = made[1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(made, [name for name, _ in kinds])

    return run


def _without(data: bytes, hit: np.ndarray) -> bytes:
    """``data`` without its hit words and what stands between two of them."""
    inside = np.frombuffer(normalised(data), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    turns = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    pieces, at = [], 0
    for first, last in zip(turns[::2].tolist(), (turns[1::2] - 1).tolist()):
        pieces.append(data[at : starts[first]])
        at = int(ends[last])
    pieces.append(data[at:])
    return b"".join(pieces)


def decontaminate(
    docs: DataFrame, items: DataFrame, most_coverage: float = MOST_COVERAGE, **settings
) -> DataFrame:
    """(id, text, n_words, n_hit) of the documents that stay, without the spans of words that ``scan`` hits.

    A span goes from its first to its last hit word; what stands around it stays as it is. Documents with
    more than ``most_coverage`` of their words hit go as a whole. Clean documents are returned unchanged, null texts as null.
    """
    found = scan(docs, items, **settings).select("id", "text", "n_words", "hits")
    return found.mapInArrow(_clean(most_coverage), "id long, text string, n_words long, n_hit long")
