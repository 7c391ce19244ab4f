"""Quality scores by histogram gradient-boosted trees over statistics of the text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.llm.text import (
    Windows,
    as_bytes,
    hasher,
    release,
    repeated_lines,
    repeated_words,
    smaller_batches,
    word_hashes,
)
from latticework.operators.joins import fresh

FEATURES = (
    "log_words", "log_chars", "word_length", "word_spread", "letters", "capitals", "digits", "spaces", "symbols",
    "marks", "stops", "other_bytes", "lines", "line_repeats", "distinct_words", "top_word", "pair_repeats",
    "window_repeats", "long_words", "short_words", "doubled_words", "byte_entropy", "longest_run",
)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_KINDS = np.zeros((7, 256), np.int64)
for _at, _bytes in enumerate(
    (
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c",
        b"#*$%&|<>=_~^@{}[]\\/", b"!?", b".,;:",
    )
):
    _KINDS[_at, list(_bytes)] = 1

# Labelled rows that the model is fitted on at most, chosen by a hash of their id.
SAMPLE = 20_000


def statistics(data: bytes, known, windows: Windows) -> list[float]:
    """The features of one whole text, in the order of FEATURES; all zero without words."""
    hashes = word_hashes(data, known)
    n = len(hashes)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(data, np.uint8)
    by_byte = np.bincount(raw, minlength=256)
    lower, upper, digits, spaces, symbols, marks, stops = (_KINDS @ by_byte / len(raw)).tolist()
    gaps = np.flatnonzero(_SPACE[raw])
    lengths = np.diff(np.concatenate([[-1], gaps, [len(raw)]])) - 1
    lengths = lengths[lengths > 0]
    share = by_byte[by_byte > 0] / len(raw)
    changes = np.flatnonzero(np.concatenate([[True], raw[1:] != raw[:-1], [True]]))
    _, times = np.unique(hashes, return_counts=True)
    pairs = windows.of(hashes, 2)
    return [
        np.log1p(n), np.log1p(len(raw)), lengths.mean(), lengths.std(), lower + upper, upper, digits, spaces, symbols,
        marks, stops, 1 - (lower + upper + digits + spaces + symbols + marks + stops), by_byte[10] / len(raw),
        repeated_lines(data) / (by_byte[10] + 1), len(times) / n, times.max() / n,
        1 - len(np.unique(pairs)) / max(1, len(pairs)), repeated_words(hashes, windows, 5) / n,
        (lengths > 15).mean(), (lengths < 3).mean(), float((hashes[1:] == hashes[:-1]).sum()) / n,
        float(-(share * np.log2(share)).sum()), np.log1p(np.diff(changes).max()),
    ]


def table_of(texts: list[bytes | None]) -> np.ndarray:
    known, windows = hasher(), Windows(0xA0761D6478BD642F)
    return np.array([statistics(t or b"", known, windows) for t in texts], np.float32).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """Complete binary trees of one depth, as arrays: node i has the children 2 i + 1 and 2 i + 2."""

    start: float
    features: np.ndarray  # tree, inner node
    borders: np.ndarray  # tree, inner node; larger values go right
    values: np.ndarray  # tree, leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        n_trees, inner = self.features.shape
        trees, rows = np.arange(n_trees)[None, :], np.arange(len(x))[:, None]
        at = np.zeros((len(x), n_trees), np.int64)
        while n_trees and at[0, 0] < inner if len(x) else False:
            right = x[rows, self.features[trees, at]] > self.borders[trees, at]
            at = 2 * at + 1 + right
        return self.start + self.values[trees, at - inner].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    n_trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    shrink: float = 2.0,
    least: float = 1.0,
) -> Trees:
    """Boosted trees for the log loss; splits by histograms of gradients over ``bins`` quantiles.

    ``shrink`` is added to each sum of second derivatives and ``least`` is what a leaf needs of them.
    Without rows, or with one label only, the score is the smoothed share of label 1.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    inner, leaves = (1 << depth) - 1, 1 << depth
    start = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        n_trees = 0
    features = np.zeros((n_trees, inner), np.int64)
    borders, values = np.full((n_trees, inner), np.inf, np.float32), np.zeros((n_trees, leaves))
    if not n_trees:
        return Trees(start, features, borders, values)
    n, n_features = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(n, start)
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        first, second = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 1 << level
            gain_best, choice = np.zeros(width), np.full((width, 2), -1)
            for f in range(n_features):
                key = node * bins + binned[:, f]
                g = np.bincount(key, first, width * bins).reshape(width, bins)
                h = np.bincount(key, second, width * bins).reshape(width, bins)
                gl, hl = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
                gt, ht = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None]
                gain = gl**2 / (hl + shrink) + (gt - gl) ** 2 / (ht - hl + shrink) - gt**2 / (ht + shrink)
                gain[(hl < least) | (ht - hl < least)] = 0
                gain[:, len(cuts[f]) :] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(width), at] > gain_best + 1e-9
                gain_best[better] = gain[np.arange(width), at][better]
                choice[better] = np.stack([np.full(width, f), at], axis=1)[better]
            for k in np.flatnonzero(choice[:, 0] >= 0):
                f, b = choice[k]
                features[t, width - 1 + k], borders[t, width - 1 + k] = f, cuts[f][b]
            split = features[t, width - 1 + node]
            node = 2 * node + (x[np.arange(n), split] > borders[t, width - 1 + node])
        g, h = np.bincount(node, first, leaves), np.bincount(node, second, leaves)
        values[t] = rate * g / (h + shrink)
        margin += values[t][node]
    return Trees(start, features, borders, values)


def held_out(id: str = "doc_id") -> Column:
    """Rows whose labels no model may see."""
    return F.crc32(F.col(id).cast("string")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id: str, text: str, sample: int) -> DataFrame:
    """(id, label, text) of at most ``sample`` labelled rows, none held out, by the order of a hash of their id.

    Labels that are null are left out; of several labels of one id the majority counts, 1 on a tie. Of several
    texts of one id the least one trains.
    """
    chosen = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(id))
        .groupBy(F.col(id).cast("long").alias("__id"))
        .agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers.
    rows = docs.select(F.col(id).cast("long").alias("__id"), F.col(text).alias("text"))
    return rows.join(F.broadcast(chosen), "__id").groupBy(F.col("__id").alias("id"), "label").agg(F.min("text").alias("text"))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in smaller_batches(batches, "text"):
        x = table_of(as_bytes(batch.column("text")))
        names = ["label", *FEATURES]
        yield pa.RecordBatch.from_arrays([batch.column("label"), *map(pa.array, np.ascontiguousarray(x.T))], names)
        release()


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
    sample: int = SAMPLE,
) -> Trees:
    """Trees fitted on the statistics of at most ``sample`` labelled documents, which the tasks compute;
    the driver gets that many rows of numbers at most, and no text."""
    fields = ", ".join(f"{name} float" for name in FEATURES)
    rows = training_rows(docs, labels, label, id, text, sample).mapInArrow(_labelled, f"label int, {fields}").toArrow()
    x = np.stack([np.asarray(rows.column(name)) for name in FEATURES], axis=1)
    y = np.asarray(rows.column("label")).astype(np.float64)
    # The order of rows depends on the tasks; sums of gradients shall not.
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def _scores(model: Trees, at: int, n_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, at):
            found = model.probability(table_of(as_bytes(batch.column(at))))
            names = [*batch.schema.names[:n_columns], "score"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_columns], pa.array(found)], names)
            release()

    return run


def score(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """``docs`` with the column score, 0 to 1, higher where label 1 is likelier.

    Each task reads whole texts and walks all trees at once in arrays. Null and empty texts are scored as a
    text without words. All columns stay, whatever their names, but one named score, in any case, is replaced. No
    rows: no rows.
    """
    rows = docs.drop("score")
    same = [at for at, name in enumerate(rows.columns) if name.lower() == text.lower()]
    if len(same) == 1 and text == rows.columns[same[0]] and not re.search(r"[.`]", text):
        kept, at = rows, same[0]
    else:
        # A field of a struct, say: it goes along once more, last.
        kept, at = rows.select("*", docs[text].alias(fresh("text", rows.columns))), len(rows.columns)
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(_scores(model, at, len(rows.columns)), schema)
