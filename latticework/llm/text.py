"""Words, their hashes and word windows, as every task of this subpackage reads them."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space; bytes.split() has the same six separators.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

# Texts are cut at white space in parts of this size, so that a very long one is never a list of words.
PART_BYTES = 1 << 20
# Distinct words that a task remembers, and the longest of them in characters: some 50 MB in all.
REMEMBERED, LONGEST = 1 << 18, 64


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give memory that was freed back to the system: a Python worker lives on between the stages of a job, and
    without this it holds the most that it ever had."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def parts(data: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``PART_BYTES``, cut at white space only."""
    start = 0
    while start < len(data):
        end = start + PART_BYTES
        cut = _SPACE.search(data, end) if end < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[start:end]
        start = end


class Remembered(dict):
    """``compute(key)``, remembered for a bounded number of keys that are not too long; the older half goes if full."""

    def __init__(self, compute: Callable, limit: int = REMEMBERED, longest: int = LONGEST):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                for old in list(islice(self, (self.limit + 1) // 2)):
                    del self[old]
            self[key] = value
        return value


def word_hashes(data: bytes, known: Remembered) -> np.ndarray:
    """The hash of each word of ``data``, in order."""
    found = []
    for part in parts(data):
        words = part.split()
        found.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def hasher(seed: int = 0) -> Remembered:
    return Remembered(lambda word: xxhash.xxh64_intdigest(word, seed))


class Windows:
    """Hashes of all windows of some words: polynomials modulo 2^64 over the words' hashes."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self._powers):
            n = max(n, 2 * len(self._powers))
            for name, base in (("_powers", self.base), ("_inverses", self.inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def of(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """The hash of each window of ``width`` words; the result is ``width - 1`` shorter."""
        n = len(hashes)
        if n < width:
            return np.empty(0, np.uint64)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self._powers[:n], out=sums[1:])
        mixed = (sums[width:] - sums[: n - width + 1]) * self._inverses[: n - width + 1]
        mixed ^= mixed >> np.uint64(29)
        return mixed * np.uint64(0xBF58476D1CE4E5B9)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``width`` words that starts at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:n]) > 0


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list:
    """UTF-8 of each text, None for null, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def smaller_batches(batches: Iterator[pa.RecordBatch], column: str | int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``most`` bytes, one row at least."""
    for batch in batches:
        at, n = 0, batch.num_rows
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        ends = np.cumsum(sizes)
        while at < n:
            base = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def block_number(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def count_blocks(docs: DataFrame, text: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` of text ``docs`` make.

    A block is what one call handles; their number follows the whole input.
    """
    total = docs.select(F.sum(F.octet_length(F.col(text))).alias("n")).first()["n"] or 0
    return max(1, -(-total // block_bytes))


def repeated_words(hashes: np.ndarray, windows: Windows, width: int) -> int:
    """How many words lie in windows of ``width`` words that occur twice or more."""
    found = windows.of(hashes, width)
    if len(found) < 2:
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return int(covered(np.flatnonzero(twice), width, len(hashes)).sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\r\x0b\x0c"):
            seen.add(line)
    return n
