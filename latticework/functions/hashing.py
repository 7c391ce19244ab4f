"""Hash expressions: SHA-256 text digests and filter buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from latticework.functions.bits import fold_to_int, long_lit

# Start value of the set hash, default filter size in bits (20 MB).
HASH_SEED = 1234
DEFAULT_FILTER_BITS = 167_772_160


def sha256_hex(col: Column) -> Column:
    """SHA-256 of the UTF-8 text in lower-case hex."""
    return F.sha2(col.cast("string"), 256)


def bucket_of_hash(code: Column, size: int) -> Column:
    """Filter bucket of a signed 32-bit hash code."""
    return F.abs(code % long_lit(size))


def bucket(key: Column, size: int) -> Column:
    """Filter bucket of an integer key (a one-word set)."""
    return bucket_of_hash(fold_to_int(key.cast("bigint").bitwiseXOR(long_lit(HASH_SEED))), size)


def text_bucket(key: Column, size: int) -> Column:
    """Filter bucket of a text key, from the first 60 bits of its SHA-256."""
    return F.conv(F.substring(sha256_hex(key), 1, 15), 16, 10).cast("bigint") % long_lit(size)
