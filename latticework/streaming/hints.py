"""Streams of records, each batch matched against the stored candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticework.operators.joins import lookup
from latticework.operators.preimage import ROWS_PER_TASK, SHUFFLED, hint_rows, match_hints
from latticework.session import materialize_buckets
from latticework.streaming.runs import run_batches

_KEYS = ["alphabet", "hint_hash"]

# Rows of one hint that a single task joins; a batch with a more frequent hint is joined by shuffling both sides.
_HOT_ROWS = 1_000_000


def _match_in_buckets(records: DataFrame, candidates: DataFrame, hot_rows: int) -> DataFrame:
    """Hints of ``records`` joined with bucketed ``candidates (alphabet, hint_hash, excluded)``, without a broadcast."""
    hints = hint_rows(records)
    hottest = hints.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    found = candidates.hint(SHUFFLED)
    # Adaptive execution splits a hot key only if both sides are shuffled for the join.
    joined = lookup(hints, found, _KEYS) if hottest > hot_rows else hints.join(found, _KEYS, "left")
    return joined.select("id", "hint_ix", "hint_hash", "excluded")


def stream_hint_match(
    records: DataFrame,
    candidates: DataFrame,
    label: str = "hint-match",
    broadcast_rows: int = 0,
    hot_rows: int = _HOT_ROWS,
) -> DataFrame:
    """``(id, hint_ix, hint_hash, excluded)`` for all records that a stream has available.

    ``candidates`` is a stored table of hashed permutations, enumerated once and not per batch. It is bucketed by
    alphabet and hash before the first batch. The hints of a batch are shuffled to the buckets, which stay in
    place, and no rows pass through the driver, however many batches there are. Only a batch that holds one hint
    more than ``hot_rows`` times shuffles the candidates too, by a join whose hot keys can be split.

    With ``broadcast_rows`` batches are matched by :func:`match_hints` instead, which broadcasts up to that many
    hints or candidates. Each batch sends them through the driver again, so this is for streams of few batches.
    """
    if broadcast_rows:
        return run_batches(
            records, label, lambda batch: match_hints(batch, candidates=candidates, broadcast_rows=broadcast_rows)
        )
    n_buckets = max(records.sparkSession.sparkContext.defaultParallelism, -(-candidates.count() // ROWS_PER_TASK))
    found = candidates.select("alphabet", F.col("cand_hash").alias("hint_hash"), "excluded")
    stored = materialize_buckets(found, f"{label}-candidates", _KEYS, n_buckets)
    return run_batches(records, label, lambda batch: _match_in_buckets(batch, stored, hot_rows))
