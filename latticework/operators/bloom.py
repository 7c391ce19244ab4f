"""Approximate membership with one-hash filters stored as packed bit tables.

A filter of ``size`` bits is ``(word_ix, word, size)`` with at most ``size / 64`` rows,
whatever the data; that bound decides whether it may be broadcast. The size goes with each
word, and filters of different sizes, or a probe of another size, fail. Keys that
share a bucket cannot be told apart: a member is never missed, a non-member may
pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.functions import bits
from latticework.functions.hashing import DEFAULT_FILTER_BITS, bucket, bucket_of_hash, text_bucket
from latticework.operators.bitset import hash_code
from latticework.operators.joins import lookup

# Filters of up to this many words (the default filter has 2,621,440) are broadcast.
BROADCAST_WORDS = 4_000_000

# Filters of up to this many buckets have their first rows broadcast.
BROADCAST_BUCKETS = 1_000_000


def bucket_of(df: DataFrame, key: str, size: int) -> Column:
    """Bucket of a text or integer key column; null for a null key.

    Other types have no bucket of their own: two values would share a key by a cast.
    """
    kind = df.schema[key].dataType
    if isinstance(kind, T.StringType):
        return text_bucket(F.col(key), size)
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{key} is {kind.simpleString()}; filters take text and integer keys")
    return bucket(F.col(key), size)


def _with_bucket(df: DataFrame, key: str, size: int) -> DataFrame:
    found = F.when(F.col(key).isNotNull(), bucket_of(df, key, size))
    return df.withColumn("bucket", found)


def set_buckets(words: DataFrame, size: int) -> DataFrame:
    """``(set_id, bucket)`` of whole sets in packed form, where a set is one element."""
    return hash_code(words).select("set_id", bucket_of_hash(F.col("hash_code"), size).alias("bucket"))


def size_for(df: DataFrame, key: str, bits_per_key: int = 16) -> int:
    """A size for a filter of the distinct keys of ``df``: a power of two of ``bits_per_key`` bits a key at least.

    With one hash that many bits let one of ``bits_per_key`` other keys pass at most.
    """
    n_keys = df.agg(F.countDistinct(key)).first()[0]
    return max(64, 1 << (bits_per_key * n_keys - 1).bit_length()) if n_keys else 64


def build(
    df: DataFrame, key: str, size: int = DEFAULT_FILTER_BITS, by: str | None = None
) -> DataFrame:
    """Filter over ``key``; with ``by`` one filter per group, keyed by ``set_id``."""
    group = [] if by is None else [F.col(by).alias("set_id")]
    rows = _with_bucket(df, key, size).select(*group, "bucket")
    return _filter_words(rows, [] if by is None else ["set_id"], size)


def _filter_words(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Filters of the column ``bucket``, one per value of ``keys``."""
    return (
        rows.where(F.col("bucket").isNotNull())
        .select(
            *keys,
            bits.word_index(F.col("bucket")).alias("word_ix"),
            bits.bit_mask(F.col("bucket")).alias("word"),
        )
        .groupBy(*keys, "word_ix")
        .agg(F.bit_or("word").alias("word"))
        .withColumn("size", F.lit(size).cast("bigint"))
    )


def build_of_sets(words: DataFrame, size: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """Filter over whole sets in packed form, each set one element."""
    return _filter_words(set_buckets(words, size), [], size)


def _of_size(filter_words: DataFrame, size: int | None = None) -> DataFrame:
    """The words, failing in the task that meets a word of another size."""
    expected = F.lit(size) if size is not None else F.col("size")
    checked = F.when(F.col("size") == expected, F.col("word")).otherwise(
        F.raise_error(F.concat(F.lit("a filter of another size: "), F.col("size").cast("string"))).cast("bigint")
    )
    return filter_words.withColumn("word", checked)


def buckets(filter_words: DataFrame) -> DataFrame:
    """``(bucket)``: the set buckets of a filter."""
    spread = filter_words.where(F.col("word") != 0).select(
        "*", F.explode(bits.positions()).alias("position")
    )
    return spread.where(bits.has_bit(F.col("word"), F.col("position"))).select(
        *[c for c in filter_words.columns if c not in ("word_ix", "word", "size")],
        (F.shiftleft("word_ix", bits.WORD_SHIFT) + F.col("position")).alias("bucket"),
    )


def merge(*filters: DataFrame) -> DataFrame:
    """Union of filters of equal size; the filters of a ``by`` build merge into one.

    Filters of different sizes fail.
    """
    words = [f.select("word_ix", "word", "size") for f in filters]
    merged = words[0]
    for other in words[1:]:
        merged = merged.unionByName(other)
    # Sizes differ anywhere, not only within a word: one row for each filter's size.
    sizes = [row["size"] for row in merged.select("size").distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError(f"filters of sizes {sorted(sizes)} cannot be merged")
    return merged.groupBy("word_ix").agg(F.bit_or("word").alias("word"), F.max("size").alias("size"))


def _probe(keyed: DataFrame, filter_words: DataFrame, size: int, how: str) -> DataFrame:
    """``keyed`` joined with the filter word of its ``bucket``, and the column ``maybe``."""
    keyed = keyed.withColumn("word_ix", bits.word_index(F.col("bucket")))
    fits = -(-size // bits.WORD_BITS) <= BROADCAST_WORDS
    words = _of_size(filter_words, size).select("word_ix", "word")
    joined = (
        keyed.join(F.broadcast(words), "word_ix", how)
        if fits
        else lookup(keyed, words, ["word_ix"], how)
    )
    hit = bits.has_bit(F.col("word"), bits.word_position(F.col("bucket")))
    return joined.withColumn("maybe", F.coalesce(hit, F.lit(False)))


def semi_join(
    df: DataFrame, key: str, filter_words: DataFrame, size: int = DEFAULT_FILTER_BITS
) -> DataFrame:
    """Rows whose key may be in the filter; a filter lookup, no shuffle of ``df``."""
    return _probe(_with_bucket(df, key, size), filter_words, size, "inner").where("maybe").select(*df.columns)


def anti_join(
    df: DataFrame, key: str, filter_words: DataFrame, size: int = DEFAULT_FILTER_BITS
) -> DataFrame:
    """Rows whose key is certainly not in the filter (a null key is in no filter)."""
    return _probe(_with_bucket(df, key, size), filter_words, size, "left").where(~F.col("maybe")).select(*df.columns)


def semi_join_sets(words: DataFrame, filter_words: DataFrame, size: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """``(set_id)`` of the packed sets that may, as a whole, be elements of the filter."""
    return _probe(set_buckets(words, size), filter_words, size, "inner").where("maybe").select("set_id")


def anti_join_sets(words: DataFrame, filter_words: DataFrame, size: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """``(set_id)`` of the packed sets that are certainly no elements of the filter."""
    return _probe(set_buckets(words, size), filter_words, size, "left").where(~F.col("maybe")).select("set_id")


def prefilter_join(
    probe: DataFrame,
    probe_key: str,
    build_side: DataFrame,
    build_key: str,
    size: int = DEFAULT_FILTER_BITS,
) -> DataFrame:
    """Inner equi-join whose probe side is thinned by the filter of the build side first."""
    words = build(build_side, build_key, size)
    thin = semi_join(probe, probe_key, words, size)
    return thin.join(build_side, thin[probe_key] == build_side[build_key])


def added_flags(
    df: DataFrame, key: str, order: str, size: int = DEFAULT_FILTER_BITS, seen: DataFrame | None = None
) -> DataFrame:
    """``df`` with ``bucket`` and ``added``: true for the first row of each bucket.

    ``order`` is a unique column. A row with a null key has no bucket and is not added. The first row of a bucket is a ``min`` with
    map-side combine; there is no window over a bucket, however full it is. With ``seen``, a filter of the same
    size, only buckets that it has free can be added to.
    """
    flags = _added(_with_bucket(df, key, size), order, size)
    if seen is not None:
        flags = _probe(flags, seen, size, "left").withColumn("added", F.col("added") & ~F.col("maybe"))
    return flags.select(*df.columns, "bucket", "added")


def extended(seen: DataFrame, flags: DataFrame, size: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """The filter ``seen`` with the buckets of ``added_flags`` set."""
    return merge(seen, _filter_words(flags.where("added"), [], size))


def added_sets(words: DataFrame, size: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """``(set_id, bucket, added)`` of the packed sets as elements, taken in the order of ``set_id``."""
    return _added(set_buckets(words, size), "set_id", size).select("set_id", "bucket", "added")


def _added(keyed: DataFrame, order: str, size: int) -> DataFrame:
    """``keyed`` with ``added`` for the first row of each bucket."""
    firsts = keyed.groupBy("bucket").agg(F.min(order).alias("first_order"))
    joined = (
        keyed.join(F.broadcast(firsts), "bucket", "left")
        if size <= BROADCAST_BUCKETS
        else lookup(keyed, firsts, ["bucket"], "left")
    )
    added = F.col("bucket").isNotNull() & (F.col(order) == F.col("first_order"))
    return joined.withColumn("added", F.coalesce(added, F.lit(False)))


def first_seen(df: DataFrame, key: str, order: str, size: int = DEFAULT_FILTER_BITS) -> DataFrame:
    """The rows that set a free bucket, taken in the order of ``order``."""
    return added_flags(df, key, order, size).where("added").drop("added")
