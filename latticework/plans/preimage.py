"""Registered queries: recovery of hashed values from declared domains and hints."""

from __future__ import annotations

from pyspark.sql import functions as F

from latticework.functions.hashing import sha256_hex
from latticework.operators import preimage as ops
from latticework.plans.inputs import (
    MAX_HINTS, RECORDS_SQL, hashed_records, plain_records, record_file_rows, table,
)
from latticework.plans.readers import write_record_files
from latticework.session import materialize, scratch_dir
from latticework.sources.records import record_schema, stream_records, with_hint_array
from latticework.streaming.hints import stream_hint_match as match_stream


# Candidates of one alphabet or domain that the query enumerates at most.
RECOVER_LIMIT = 10_000_000

# Strings of a domain in the first slice; the domains have 256.
FIRST_SLICE = 16


def sha256_column(spark, sf_dir):
    """Digest of every whole document."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", sha256_hex(F.col("text")).alias("digest")
    )


def perm_candidates(spark, sf_dir):
    return ops.permutations(hashed_records(spark, sf_dir).select("alphabet"))


def perm_ranges(spark, sf_dir):
    """The middle third of the numbered candidates of each alphabet, computed alone."""
    alphabets = hashed_records(spark, sf_dir).select("alphabet").distinct()
    n = ops.n_permutations(F.col("alphabet")).cast("bigint")
    third = F.call_function("div", n, F.lit(3))
    return ops.permutations_between(alphabets.select("alphabet", third.alias("first"), (third * 2).alias("last")))


def tuple_candidates(spark, sf_dir):
    """All strings over the two-symbol domains that the plain records declare."""
    letters = F.sort_array(F.array_distinct(F.split("value", "")))
    domains = plain_records(spark, sf_dir).select(
        F.array_join(letters, "").alias("universe"), "plen"
    )
    return ops.tuples(domains)


def preimage_hints(spark, sf_dir):
    return ops.match_hints(hashed_records(spark, sf_dir)).select("id", "hint_ix", "excluded")


def preimage_universe(spark, sf_dir):
    return ops.remaining_universe(hashed_records(spark, sf_dir)).select(
        "id", F.array_join("excluded", "").alias("excluded"), "universe"
    )


def preimage_recover(spark, sf_dir):
    """Good records beside damaged ones: some declare a hash that no string of their domain has,
    some a length that makes their domain too large, and some have a wrong hint."""
    kind = F.col("id") % 7
    records = hashed_records(spark, sf_dir).withColumns(
        {
            "value_hash": F.when(kind == 3, sha256_hex(F.col("alphabet"))).otherwise(F.col("value_hash")),
            "plen": F.when(kind == 6, F.lit(40)).otherwise(F.col("plen")),
            "hints": F.when(
                kind == 5, F.transform("hints", lambda h, i: F.when(i == 0, sha256_hex(h)).otherwise(h))
            ).otherwise(F.col("hints")),
        }
    )
    return ops.recover(records, max_candidates=RECOVER_LIMIT)


def preimage_slices(spark, sf_dir):
    """Recovery that leaves a domain once all its values are found; some records have no value there, some are refused."""
    kind = F.col("id") % 7
    records = hashed_records(spark, sf_dir).withColumns(
        {
            "value_hash": F.when(kind == 3, sha256_hex(F.col("alphabet"))).otherwise(F.col("value_hash")),
            "plen": F.when(kind == 6, F.lit(40)).otherwise(F.col("plen")),
        }
    )
    return ops.recover_in_slices(records, max_candidates=RECOVER_LIMIT, first_slice=FIRST_SLICE, growth=2)


def stream_hint_match(spark, sf_dir):
    path = scratch_dir(spark, "record-files")
    write_record_files(record_file_rows(spark, sf_dir), path)
    records = stream_records(spark, record_schema(MAX_HINTS), path, files_per_batch=2)
    candidates = materialize(
        ops.hashed_permutations(hashed_records(spark, sf_dir).select("alphabet")), "candidates"
    )
    return match_stream(with_hint_array(records), candidates).select("id", "hint_ix", "excluded")


QUERIES = {
    "sha256_column": sha256_column,
    "perm_candidates": perm_candidates,
    "perm_ranges": perm_ranges,
    "tuple_candidates": tuple_candidates,
    "preimage_hints": preimage_hints,
    "preimage_universe": preimage_universe,
    "preimage_recover": preimage_recover,
    "preimage_slices": preimage_slices,
    "stream_hint_match": stream_hint_match,
}

_WITH = f"WITH RECURSIVE {RECORDS_SQL}"

_PERMS = f"""{_WITH},
alphabets AS (SELECT DISTINCT alphabet FROM rec_base),
step(alphabet, cand, rest) AS (
  SELECT alphabet, '', alphabet FROM alphabets
  UNION ALL
  SELECT alphabet, cand || s, replace(rest, s, '')
  FROM (SELECT alphabet, cand, rest, unnest(string_split(rest, '')) AS s FROM step WHERE length(rest) > 1))"""

ORACLES = {
    "sha256_column": "SELECT doc_id, sha256(text) AS digest FROM documents",
    "perm_candidates": f"{_PERMS} SELECT alphabet, cand, rest AS excluded FROM step WHERE length(rest) = 1",
    "perm_ranges": f"""{_PERMS},
numbered AS (
  SELECT alphabet, cand, rest AS excluded, row_number() OVER (PARTITION BY alphabet ORDER BY cand || rest) - 1 AS number,
    count(*) OVER (PARTITION BY alphabet) // 3 AS third
  FROM step WHERE length(rest) = 1)
SELECT alphabet, number, cand, excluded FROM numbered WHERE number BETWEEN third AND third * 2""",
    "tuple_candidates": f"""{_WITH},
domains AS (
  SELECT DISTINCT array_to_string(list_sort(list_distinct(string_split(value, ''))), '') AS universe FROM rec_value),
step(universe, cand) AS (
  SELECT universe, '' FROM domains
  UNION ALL
  SELECT universe, cand || s
  FROM (SELECT universe, cand, unnest(string_split(universe, '')) AS s FROM step WHERE length(cand) < 8))
SELECT universe, 8 AS plen, cand FROM step WHERE length(cand) = 8""",
    "preimage_hints": f"{_WITH} SELECT id, hint_ix, excluded FROM rec_hint",
    "preimage_universe": f"""{_WITH}
SELECT id, array_to_string(list_filter(letters, lambda s: s <> a AND s <> b), '') AS excluded,
       array_to_string(list_filter(letters, lambda s: s = a OR s = b), '') AS universe
FROM rec_value""",
    "preimage_recover": f"""{_WITH} SELECT id, CASE WHEN id % 7 NOT IN (3, 6) THEN value END AS value,
  CASE id % 7 WHEN 3 THEN 'unresolved' WHEN 6 THEN 'refused' ELSE 'found' END AS status FROM rec_value""",
    "preimage_slices": f"""{_WITH},
numbered AS (
  SELECT id, id % 7 AS kind, value, least(a, b) || greatest(a, b) AS universe,
    list_sum(list_transform(range(8), lambda i: CASE WHEN substr(value, i + 1, 1) = greatest(a, b) THEN 1 << (7 - i) ELSE 0 END)) AS number
  FROM rec_value),
sliced AS (
  SELECT *, CASE WHEN kind IN (3, 6) THEN NULL WHEN number < {FIRST_SLICE} THEN 1 WHEN number < {3 * FIRST_SLICE} THEN 2
    WHEN number < {7 * FIRST_SLICE} THEN 3 WHEN number < {15 * FIRST_SLICE} THEN 4 ELSE 5 END AS slice
  FROM numbered)
SELECT id, CASE WHEN slice IS NOT NULL THEN value END AS value,
  CASE kind WHEN 3 THEN 'unresolved' WHEN 6 THEN 'refused' ELSE 'found' END AS status, slice,
  CASE WHEN kind = 6 THEN 0 ELSE max(CASE WHEN kind = 3 THEN 5 ELSE slice END) OVER (PARTITION BY universe, kind = 6) END AS n_slices
FROM sliced""",
    "stream_hint_match": f"{_WITH} SELECT id, hint_ix, excluded FROM rec_hint",
}
