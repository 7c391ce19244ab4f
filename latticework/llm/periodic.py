"""Periodic runs of words: longest common extensions by suffix trees, Lyndon roots as candidates."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticework.llm.text import as_bytes, smaller_batches

# A run has so many words, and repeats its period so often, at least.
LEAST_WORDS, LEAST_POWER = 6, 4
# Positions of an Euler tour that a block of the minimum search holds.
BLOCK = 16

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Minima:
    """Least values of ranges in constant time: whole blocks by a sparse table, the ends by running minima."""

    def __init__(self, values: np.ndarray):
        n = -(-len(values) // BLOCK) * BLOCK
        self.values = np.append(values, np.full(n - len(values), np.iinfo(np.int32).max, np.int32)).astype(np.int32)
        blocks = self.values.reshape(-1, BLOCK)
        self.upto = np.minimum.accumulate(blocks, axis=1).ravel()
        self.onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [blocks.min(axis=1)]
        while 2 << len(self.table) - 1 <= len(blocks):
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value of each range from ``first`` to ``last``, both inside."""
        one, two = first // BLOCK, last // BLOCK
        found = np.minimum(self.onward[first], self.upto[last])
        near = one == two
        if near.any():
            steps = first[near][:, None] + np.arange(BLOCK)[None, :]
            inside = np.minimum(steps, last[near][:, None])
            found[near] = self.values[inside].min(axis=1)
        between = np.flatnonzero(two - one > 1)
        if len(between):
            a, b = one[between] + 1, two[between]
            level = np.frexp((b - a).astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                at = level == k
                least = np.minimum(self.table[k][a[at]], self.table[k][b[at] - (1 << k)])
                found[between[at]] = np.minimum(found[between[at]], least)
        return found


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers below ``len(sequence)``, with an end that is less than all of them."""

    def __init__(self, sequence: np.ndarray):
        self.n = n = len(sequence)
        symbols = (sequence + 1).tolist() + [0]
        base = n + 2
        # Inner nodes have the length of what they spell; the edge to a node begins with symbols[start].
        start, stop, link, parent, depth, suffix = [0], [0], [0], [0], [0], [-1]
        child: dict[int, int] = {}
        leaf_end = n + 1
        node = edge = length = rest = made = 0
        for i, symbol in enumerate(symbols):
            rest += 1
            waiting = 0
            while rest:
                if not length:
                    edge = i
                key = node * base + symbols[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    stop.append(leaf_end)
                    link.append(0)
                    parent.append(node)
                    depth.append(leaf_end - made)
                    suffix.append(made)
                    made += 1
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    begin = start[below]
                    end = stop[below]
                    span = (end if end <= i else i + 1) - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    other = symbols[begin + length]
                    if other == symbol:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = len(start)
                    child[key] = split
                    child[split * base + other] = below
                    child[split * base + symbol] = split + 1
                    start += (begin, i)
                    stop += (begin + length, leaf_end)
                    link += (0, 0)
                    parent += (node, split)
                    depth += (rest - 1, leaf_end - made)
                    suffix += (-1, made)
                    made += 1
                    start[below] = begin + length
                    parent[below] = split
                    if waiting:
                        link[waiting] = split
                    waiting = split
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        del child, stop, link
        self.depth, self.suffix = np.array(depth, np.int32), np.array(suffix, np.int64)
        self.parent = np.array(parent, np.int64)
        self.label = np.array(symbols, np.int64)[np.array(start, np.int64)]

    def _walk(self, order: np.ndarray, tour: bool) -> np.ndarray:
        """Leaves in depth-first order of their siblings' ``order``, or the Euler tour of all nodes."""
        m = len(self.parent)
        kids = np.lexsort((order[1:], self.parent[1:])) + 1
        first = np.searchsorted(self.parent[kids], np.arange(m + 1)).tolist()
        kids = kids.tolist()
        out, stack = [], [0]
        if not tour:
            while stack:
                node = stack.pop()
                a, b = first[node], first[node + 1]
                if a == b:
                    out.append(node)
                else:
                    stack += kids[a:b][::-1]
            return np.array(out, np.int64)
        while stack:
            node = stack.pop()
            out.append(node)
            if node > 0:
                for kid in kids[first[node] : first[node + 1]]:
                    stack += (-node, kid)
            elif not node:
                for kid in kids[first[0] : first[1]]:
                    stack += (-m, kid)
        found = np.abs(np.array(out, np.int64))
        found[found == m] = 0
        return found

    def prepare(self) -> SuffixTree:
        """Makes ``extension`` ready: the Euler tour's depths and where each suffix is first met."""
        tour = self._walk(self.label, True)
        met, at = self.suffix[tour], np.arange(len(tour))
        leaves = met >= 0
        self.place = np.zeros(self.n + 1, np.int64)
        self.place[met[leaves]] = at[leaves]
        self.minima = Minima(self.depth[tour])
        return self

    def ranks(self, falling: bool = False) -> np.ndarray:
        """The order of the suffixes, the end included; with ``falling`` numbers count the other way round, while
        the end stays least."""
        order = np.where(self.label == 0, np.iinfo(np.int64).min, -self.label) if falling else self.label
        found = np.empty(self.n + 1, np.int64)
        found[self.suffix[self._walk(order, False)]] = np.arange(self.n + 1)
        return found

    def extension(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How far the suffixes at ``one`` and ``two``, different positions, are the same."""
        a, b = self.place[one], self.place[two]
        return self.minima.of(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def _lyndon_ends(ranks: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word ends that starts at each position: at the next smaller suffix."""
    values, n = ranks.tolist(), len(ranks) - 1
    found, stack = [0] * n, [n]
    for at in range(n - 1, -1, -1):
        rank = values[at]
        while values[stack[-1]] > rank:
            stack.pop()
        found[at] = stack[-1]
        stack.append(at)
    return np.array(found, np.int64)


def _all_runs(sequence: np.ndarray, least: int, power: int) -> np.ndarray:
    """(start, length, period) of every run, each once; rows by start, then period."""
    n = len(sequence)
    tree, back = SuffixTree(sequence).prepare(), SuffixTree(sequence[::-1]).prepare()
    at, found = np.arange(n), []
    for falling in (False, True):
        # The longest Lyndon words of both orders hold a root of every run.
        ends = _lyndon_ends(tree.ranks(falling))
        period = ends - at
        onward, before = np.zeros(n, np.int64), np.zeros(n, np.int64)
        some = ends < n
        onward[some] = tree.extension(at[some], ends[some])
        some = at > 0
        before[some] = back.extension(n - at[some], n - ends[some])
        length = before + period + onward
        keep = (length >= np.maximum(least, power * period)) & (power >= 2)
        found.append(np.stack([at - before, length, period], axis=1)[keep])
    rows = np.unique(np.concatenate(found)[:, [0, 2, 1]], axis=0)
    return rows[:, [0, 2, 1]]


def _stretches(words: np.ndarray, least: int, power: int) -> np.ndarray:
    """Numbers of the stretches of words that a run may lie in; -1 elsewhere.

    Every pair of neighbours inside a run comes ``power - 1`` times in it at least, so a pair that is rarer in its
    stretch is in no run, and the stretch ends between its words; again until nothing changes.
    """
    n, times = len(words), max(power - 1, 1)
    numbers = np.full(n, -1, np.int64)
    if n < max(least, power):
        return numbers
    # Counts of a hash are never too small.
    mask = (1 << (2 * n).bit_length()) - 1
    hashed = (words[:-1] * 0x9E3779B1 + words[1:]) & mask
    live = np.flatnonzero(np.bincount(hashed, minlength=mask + 1)[hashed] >= times)
    _, pairs = np.unique(words[live] * n + words[live + 1], return_inverse=True)
    while len(live):
        stretch = np.cumsum(np.append(0, np.diff(live) > 1))
        _, which, count = np.unique(stretch * n + pairs, return_inverse=True, return_counts=True)
        keep = (count[which] >= times) & (np.bincount(stretch)[stretch] >= least - 1)
        if keep.all():
            numbers[live] = stretch
            numbers[live + 1] = stretch
            return numbers
        live, pairs = live[keep], pairs[keep]
    return numbers


def runs_of(words: np.ndarray, least: int = LEAST_WORDS, power: int = LEAST_POWER) -> np.ndarray:
    """(start, length, period) of the runs of ``words`` (numbers), by start, then period.

    A run is a stretch with smallest period q of at least ``least`` words and ``power * q`` (2 or more) that no
    neighbour extends. The trees hold the stretches that runs can lie in, each ended by a number of its own.
    """
    if power < 2:
        raise ValueError("a run repeats its period")
    numbers = _stretches(words, least, power)
    at = np.flatnonzero(numbers >= 0)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # A border that equals nothing else between stretches; runs never reach over it.
    ends = np.flatnonzero(np.diff(numbers[at]) != 0) + 1
    _, sequence = np.unique(words[at], return_inverse=True)
    borders = int(sequence.max()) + 1 + np.arange(len(ends))
    found = _all_runs(np.insert(sequence, ends, borders), least, power)
    place = np.insert(at, ends, -1)
    found[:, 0] = place[found[:, 0]]
    return found


def _numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter([known.setdefault(word, len(known)) for word in words], np.int64, len(words))


def _runs(least: int, power: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, "text", 4 << 20):
            found, sizes, texts = [], [], []
            for data in as_bytes(batch.column("text")):
                words = (data or b"").split()
                rows = runs_of(_numbered(words), least, power)
                if len(rows):
                    gone = np.zeros(len(words), bool)
                    for start, length, period in rows.tolist():
                        gone[start + period : start + length] = True
                    words = compress(words, (~gone).tolist())
                texts.append(b" ".join(words))
                found.append(rows)
                sizes.append(len(rows))
            table = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            structs = pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in table.T], ["start", "length", "period"]
            )
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), structs)
            collapsed = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists, collapsed], ["id", "runs", "collapsed"])

    return run


def periodic_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, power: int = LEAST_POWER
) -> DataFrame:
    """(id, runs, collapsed) of each row: every run of words of its whole text, and the text without repeats.

    A run is a stretch of words with smallest period q, of ``least`` words and ``power * q`` at least, that no
    neighbouring word extends; ``runs`` are structs (start, length, period) by start, then period, start as
    a word's number from 0. ``collapsed`` joins by one space the words that no run holds after its first q words.

    Longest common extensions come from Ukkonen trees of the words and of their reversal, by constant-time
    lowest common ancestors on their Euler tours; the longest Lyndon word at each position, in both orders of
    the words, is a root that is extended both ways. Only stretches where each pair of neighbours
    comes ``power - 1`` times go into the trees, which no run is lost by. No shuffle: a row is handled alone,
    in memory proportional to its own text.

    Null and empty texts have no runs and collapse to the empty text. Null ids, repeated ids and repeated rows
    keep their rows; other columns are not read, whatever their names. No rows: no rows.
    """
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _runs(least, power), f"id long, runs {RUNS}, collapsed string"
    )
