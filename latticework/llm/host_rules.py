"""Quality rules by document, and by host with rates shrunk towards all hosts."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticework.llm.text import Windows, as_bytes, hasher, repeated_lines, repeated_words, smaller_batches, word_hashes
from latticework.operators.joins import lookup
from latticework.session import materialize

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# A document fails a rule where its condition holds.
BASE_RULES = {"short": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words"}
RULES = BASE_RULES | {"symbols": "5 * n_symbols > word_chars", "lines": "2 * n_dup_lines > n_words"}
# A host is refused if most of its documents fail a rule, by the shrunk rate. It is also refused if a tenth of them do and
# even the lower bound of its rate, so many standard deviations below, is above this multiple of all hosts' rate.
HOST_LIMIT, LEAST_RATE, BELOW, TIMES_MEAN = 0.5, 0.1, 2.0, 3.0
# Documents that the prior weighs at most, where all hosts have the same rate.
MOST_PRIOR = 10_000.0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, windows = hasher(), Windows(0xA0761D6478BD642F)
    kinds = np.zeros((2, 256), np.int64)
    kinds[0] = [b & 0xC0 != 0x80 and b not in b" \t\n\r\x0b\x0c" for b in range(256)]
    kinds[1] = [b in SYMBOLS for b in range(256)]
    for batch in smaller_batches(batches, "text"):
        rows = []
        for data in as_bytes(batch.column("text")):
            data = data or b""
            hashes = word_hashes(data, known)
            chars = kinds @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
            rows.append((len(hashes), *chars, repeated_lines(data), repeated_words(hashes, windows, 5)))
        columns = np.array(rows, np.int64).reshape(-1, len(COUNTS)).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("host"), *map(pa.array, columns)], ["id", "host", *COUNTS]
        )


def counts(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of each whole text.

    Words are separated by ASCII white space; ``word_chars`` are the code points in them; symbols are
    ``#*$%&|<>``; a repeated line has a word and equals an earlier line; repeated words lie in windows
    of five words found twice or more. Null and empty texts count zero.
    """
    fields = ", ".join(f"{name} long" for name in COUNTS)
    return docs.select(
        F.col(id).cast("long").alias("id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text")
    ).mapInArrow(_counts, f"id long, host string, {fields}")


def host_verdicts(judged: DataFrame, rules: list[str], limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, rate_RULE..., least_RULE..., host_ok): failure rates of each host under each rule, shrunk, and
    lower bounds of them.

    ``judged`` has the column host and a boolean column per rule. All hosts give a beta prior by the
    method of moments: its mean is the overall rate and its weight ``m (1 - m) / v - 1`` documents, where
    ``v`` is the variance between hosts beyond what chance gives hosts of one rate (at most ``MOST_PRIOR``, and at least
    one). The lower bound is ``BELOW`` standard deviations of the posterior below its mean, the shrunk rate. A host is not
    ok if a shrunk rate is above ``limit``, or if it is ``LEAST_RATE`` at least and its lower bound is above
    ``TIMES_MEAN`` times the rate of all hosts: hosts are judged against each other, and none is refused where all are
    alike. Rows without host are one host. One row a host leaves each task.
    """
    fails = [F.sum(F.col(rule).cast("double")).alias(f"fails_{rule}") for rule in rules]
    hosts = judged.groupBy("host").agg(F.count("*").cast("double").alias("n_docs"), *fails)

    def moments(rule: str) -> list[Column]:
        f, n = F.sum(f"fails_{rule}"), F.sum("n_docs")
        square = F.sum(F.col(f"fails_{rule}") * F.col(f"fails_{rule}") / F.col("n_docs"))
        chance = (f / n) * (1 - f / n) * (F.count("*") - 1) / n
        return [(f / n).alias(f"mean_{rule}"), (square / n - (f / n) * (f / n) - chance).alias(f"var_{rule}")]

    # One row for all hosts.
    prior = hosts.agg(*(c for rule in rules for c in moments(rule))).first()

    def weight(rule: str) -> tuple[float, float]:
        mean, variance = prior[f"mean_{rule}"] or 0.0, max(prior[f"var_{rule}"] or 0.0, 1e-12)
        return mean, min(max(mean * (1 - mean) / variance - 1, 1.0), MOST_PRIOR)

    def shrunk(rule: str) -> Column:
        mean, documents = weight(rule)
        return (F.col(f"fails_{rule}") + documents * mean) / (F.col("n_docs") + documents)

    def least(rule: str) -> Column:
        rate, documents = F.col(f"rate_{rule}"), weight(rule)[1]
        return rate - BELOW * F.sqrt(rate * (1 - rate) / (F.col("n_docs") + documents + 1))

    def refused(rule: str) -> Column:
        rate = F.col(f"rate_{rule}")
        far = (rate >= LEAST_RATE) & (F.col(f"least_{rule}") > TIMES_MEAN * weight(rule)[0])
        return (rate > limit) | far

    rated = hosts.withColumns({f"rate_{rule}": shrunk(rule) for rule in rules})
    rated = rated.withColumns({f"least_{rule}": least(rule) for rule in rules})
    ok = ~functools.reduce(lambda a, b: a | b, map(refused, rules), F.lit(False))
    kept = [f"{kind}_{rule}" for kind in ("rate", "least") for rule in rules]
    return rated.select("host", F.col("n_docs").cast("long"), *kept, ok.alias("host_ok"))


def judge(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: dict[str, str] = RULES,
    base: tuple[str, ...] = tuple(BASE_RULES),
    limit: float = HOST_LIMIT,
) -> DataFrame:
    """(id, host, counts..., RULE..., base_failed, host_ok, kept) of each row of ``docs``.

    ``rules`` are SQL conditions over the counts. A document fails the base if it fails a rule of
    ``base``, and is kept if it does not and its host is ok by ``host_verdicts``. Host verdicts come back by
    a join whose hot hosts can be split. Null ids and repeated rows keep their rows; a null host is one host;
    other columns are not read. No rows: no rows.
    """
    judged = counts(docs, id, text, host)
    for name, condition in rules.items():
        judged = judged.withColumn(name, F.expr(condition))
    judged = judged.withColumn("base_failed", F.greatest(F.lit(False), *(F.col(name) for name in base)))
    # A key that is never null; the mark keeps a host named like it apart.
    judged = judged.withColumn("host_key", F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")))
    judged = materialize(judged, "host-rules")
    verdicts = host_verdicts(judged.withColumn("host", F.col("host_key")), list(rules), limit)
    verdicts = verdicts.select(F.col("host").alias("host_key"), "host_ok")
    return (
        lookup(judged, verdicts, ["host_key"])
        .withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))
        .drop("host_key")
    )
