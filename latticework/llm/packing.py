"""Cost-balanced packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticework.llm.text import as_bytes, smaller_batches
from latticework.llm.tokens import encoder

CAPACITY = 4096
# Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n, as of a layer whose attention equals the
# other work at 12,288 tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 12288
# Sequences that are balanced together.
GROUP = 256
# Ids that a task sends on at once.
BATCH_BYTES = 2 << 20

FIELDS = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def assign(lengths: np.ndarray, capacities: np.ndarray, linear: float, quadratic: float) -> list[tuple]:
    """Pieces (item, start, length, sequence, offset) that fill ``capacities`` with the items.

    Items go in descending order, each to the sequence of the lowest cost with room for it. An item
    that fits nowhere is cut: its head fills the cheapest sequence that has any room, and the rest goes
    on. The capacities must hold all items; ties go to the earlier item and sequence.
    """
    room, cost, found = capacities.astype(np.int64), np.zeros(len(capacities)), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[item])
        while left:
            fits = room >= left
            at = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            take = min(left, int(room[at]))
            found.append((item, start, take, at, int(capacities[at] - room[at])))
            room[at] -= take
            cost[at] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return found


def powers(n: int) -> list[int]:
    """Powers of two that sum to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    """Takes documents one by one and gives packed groups of sequences."""

    def __init__(self, first_sequence: int, capacity: int, linear: float, quadratic: float, group: int):
        self.next, self.capacity, self.costs, self.group = first_sequence, capacity, (linear, quadratic), group
        self.items, self.held = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[tuple]]:
        """Parts of whole sequences at once; what is left of a document waits for its group."""
        total, start = len(ids) // 4, 0
        while total - start >= self.capacity:
            yield [(doc_id, start, self.capacity, total, self.next, 0, ids[4 * start : 4 * (start + self.capacity)])]
            self.next += 1
            start += self.capacity
        if start < total:
            self.items.append((doc_id, start, total, ids[4 * start :]))
            self.held += total - start
        if self.held >= self.group * self.capacity:
            yield self._pack(last=False)

    def finish(self) -> Iterator[list[tuple]]:
        if self.held:
            yield self._pack(last=True)

    def _pack(self, last: bool) -> list[tuple]:
        whole, rest = divmod(self.held, self.capacity)
        items, self.items, self.held = self.items, [], 0
        if not last and rest:
            # The end of the newest document opens the next group.
            doc_id, start, total, ids = items.pop()
            cut = len(ids) // 4 - rest
            self.items, self.held = [(doc_id, start + cut, total, ids[4 * cut :])], rest
            if cut:
                items.append((doc_id, start, total, ids[: 4 * cut]))
        capacities = [self.capacity] * whole + (powers(rest) if last else [])
        lengths = np.array([len(ids) // 4 for *_, ids in items], np.int64)
        rows = []
        for item, start, length, at, offset in assign(lengths, np.array(capacities), *self.costs):
            doc_id, begun, total, ids = items[item]
            piece = ids[4 * start : 4 * (start + length)]
            rows.append((doc_id, begun + start, length, total, self.next + at, offset, piece))
        self.next += len(capacities)
        return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in FIELDS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _pack(tokenizer: str, end_id: int, *settings):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_all
        packer, rows, held = _Packer(TaskContext.get().partitionId() << 40, *settings), [], 0
        for batch in smaller_batches(batches, "text", 2 << 20):
            for doc_id, ids in zip(batch.column("id").to_pylist(), encode(as_bytes(batch.column("text")))):
                for more in packer.add(doc_id, ids + end):
                    rows.extend(more)
                    held += sum(len(row[-1]) for row in more)
                    if held >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        for more in packer.finish():
            rows.extend(more)
        if rows:
            yield _batch(rows)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    group: int = GROUP,
) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most ``capacity`` tokens.

    Each document is the ids of its whole text by the tokenizer file at ``tokenizer`` (a path that
    every executor has) and ``end_id``. Each id is in exactly one piece: (doc_id, start, length, doc_tokens,
    sequence_id, offset, ids), ids little-endian unsigned 32-bit. Whole sequences are cut from long
    documents; what is left is packed by ``assign``, in groups of ``group`` sequences that are filled to
    the last token. The last tokens of a task fill sequences whose capacities are powers of two, so
    nothing is padded. No shuffle: each task packs what it reads, holding one group.

    A null or empty text is ``end_id`` alone; a null id stays null; repeated rows are packed as often as
    they come; other columns are not read. Sequence ids hold the task's number above 40 bits. No
    rows: no rows.
    """
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        _pack(tokenizer, end_id, capacity, linear, quadratic, group), FIELDS
    )
