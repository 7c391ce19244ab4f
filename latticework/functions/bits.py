"""Column expressions on 64-bit words.

Bit ``b`` of a set lives in word ``b >> 6`` at position ``b & 63``. Words are
signed 64-bit integers, so position 63 makes a word negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_SHIFT = 6
WORD_BITS = 1 << WORD_SHIFT
ALL_ONES = -1
MAX_LONG = (1 << 63) - 1
LOW_32 = (1 << 32) - 1


def long_lit(value: int) -> Column:
    return F.lit(value).cast("bigint")


def word_index(bit: Column) -> Column:
    return F.shiftright(bit, WORD_SHIFT)


def word_position(bit: Column) -> Column:
    return bit.bitwiseAND(long_lit(WORD_BITS - 1)).cast("int")


def shift_left(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by)


def shift_right(value: Column, by: Column) -> Column:
    """Logical (zero-filling) shift."""
    return F.call_function("shiftrightunsigned", value, by)


def bit_mask(bit: Column) -> Column:
    """The word that has just ``bit`` set."""
    return shift_left(long_lit(1), word_position(bit))


def has_bit(word: Column, position: Column) -> Column:
    return F.call_function("bit_get", word, position) == F.lit(1)


def positions() -> Column:
    """The array 0..63, folded to a literal by the optimizer."""
    return F.sequence(F.lit(0), F.lit(WORD_BITS - 1))


def set_positions(word: Column) -> Column:
    """Positions of the set bits of ``word`` as a sorted array."""
    return F.filter(positions(), lambda p: has_bit(word, p))


def trailing_ones(word: Column) -> Column:
    """Length of the run of ones that starts at position 0."""
    return (
        F.when(word == F.lit(ALL_ONES), F.lit(WORD_BITS))
        .when(word == F.lit(MAX_LONG), F.lit(WORD_BITS - 1))
        .otherwise(F.bit_count(word.bitwiseXOR(word + long_lit(1))) - F.lit(1))
    )


def trailing_zeros(word: Column) -> Column:
    """Position of the lowest set bit; 64 for an empty word."""
    return trailing_ones(F.bitwise_not(word))


def from_position(position: Column) -> Column:
    """Ones at ``position`` and above."""
    return shift_left(long_lit(ALL_ONES), position)


def up_to_position(position: Column) -> Column:
    """Ones at ``position`` and below."""
    return shift_right(long_lit(ALL_ONES), F.lit(WORD_BITS - 1) - position)


def width(word: Column) -> Column:
    """Position of the highest set bit plus one; 0 for an empty word."""
    return F.when(word == F.lit(0), F.lit(0)).otherwise(F.length(F.bin(word)))


def wrapping_multiply(word: Column, factor: Column) -> Column:
    """Product modulo 2^64 for a factor in [0, 2^31).

    Plain ``*`` raises on overflow in ANSI mode, so the two 32-bit halves are
    multiplied apart and put together again.
    """
    mask = long_lit(LOW_32)
    low = word.bitwiseAND(mask) * factor
    high = F.shiftrightunsigned(word, 32) * factor
    top = (high.bitwiseAND(mask) + F.shiftrightunsigned(low, 32)).bitwiseAND(mask)
    return F.shiftleft(top, 32).bitwiseOR(low.bitwiseAND(mask))


def fold_to_int(value: Column) -> Column:
    """Xor of the two halves of a 64-bit value, read as a signed 32-bit number."""
    low = F.shiftright(value, 32).bitwiseXOR(value).bitwiseAND(long_lit(LOW_32))
    return F.when(low >= long_lit(1 << 31), low - long_lit(1 << 32)).otherwise(low)
