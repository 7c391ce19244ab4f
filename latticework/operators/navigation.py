"""Nearest members, free gaps and runs of sets stored as tables.

A set may hold most of the data, so no window runs over the members of a set. Positions
are cut into blocks of 2^16; windows run per block, and a table with one row per block
carries results over block borders. As a sparse set has as many blocks as members, that table
is itself cut into blocks of 2^22 of its rows, so that one row is left for each 2^38 positions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latticework.functions import bits
from latticework.operators.bitset import pack
from latticework.operators.joins import lookup

BLOCK_SHIFT = 16
# Blocks that one window of the next level takes, and bits of a block number that a set's own window may have.
LEVEL_SHIFT, LAST_BITS = 22, 25
# Bits of a position and of a word's index.
POSITION_BITS, WORD_IX_BITS = 63, 57


def asof(
    points: DataFrame,
    probes: DataFrame,
    values: list[str],
    forward: bool,
    block_shift: int = BLOCK_SHIFT,
    own: str | None = None,
    position_bits: int = POSITION_BITS,
) -> DataFrame:
    """Nearest point at or before (``forward``: at or after) each distinct probe.

    ``points`` is ``(set_id, bit, *values)`` where each value grows with ``bit``
    within a set, so the nearest point has the largest (smallest) value seen so
    far. Returns ``(set_id, from_bit, *values)`` with nulls where there is none.

    With ``own`` the point at the probe itself does not count as near; its bit
    column ``own`` is returned instead.
    """
    nearest = F.min if forward else F.max
    position = F.col("position").desc() if forward else F.col("position").asc()
    kept = [own] if own else []
    tagged = points.select(
        "set_id", F.col("bit").alias("position"), *values, *kept, F.lit(False).alias("asked")
    ).unionByName(
        probes.select("set_id", F.col("from_bit").alias("position"), F.lit(True).alias("asked")),
        allowMissingColumns=True,
    )
    # One row per position: repeated points and probes fall together on the map side.
    rows = (
        tagged.groupBy("set_id", "position")
        .agg(
            *[nearest(v).alias(v) for v in values],
            *[F.bit_or(k).alias(k) for k in kept],
            F.bool_or("asked").alias("asked"),
        )
        .withColumn("block", F.shiftright("position", block_shift))
    )
    in_block = (
        Window.partitionBy("set_id", "block")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, -1 if own else Window.currentRow)
    )
    near = rows.select(
        "set_id", "block", "position", "asked", *kept,
        *[nearest(v).over(in_block).alias(v) for v in values],
    ).where("asked")
    blocks = rows.groupBy("set_id", "block").agg(*[nearest(v).alias(v) for v in values])
    carried = _carried(blocks, values, forward, position_bits - block_shift)
    return near.join(carried, ["set_id", "block"], "left").select(
        "set_id",
        F.col("position").alias("from_bit"),
        *[F.coalesce(F.col(v), F.col(f"carried_{v}")).alias(v) for v in values],
        *kept,
    )


def _carried(blocks: DataFrame, values: list[str], forward: bool, n_bits: int) -> DataFrame:
    """``(set_id, block, carried_*)``: what comes to each block from those before (after) it in its set.

    ``blocks`` has one row a block, whose numbers have ``n_bits`` bits at most.
    """
    nearest = F.min if forward else F.max
    order = F.col("block").desc() if forward else F.col("block").asc()
    names = [f"carried_{v}" for v in values]
    last = n_bits <= LAST_BITS
    upper = F.shiftright("block", LEVEL_SHIFT) if not last else bits.long_lit(0)
    leveled = blocks.withColumn("upper", upper)
    keys = ["set_id"] if last else ["set_id", "upper"]
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    near = leveled.select("set_id", "upper", "block", *[nearest(v).over(earlier).alias(n) for v, n in zip(values, names)])
    if last:
        return near.drop("upper")
    uppers = leveled.groupBy("set_id", F.col("upper").alias("block")).agg(*[nearest(v).alias(v) for v in values])
    above = _carried(uppers, values, forward, n_bits - LEVEL_SHIFT).select(
        "set_id", F.col("block").alias("upper"), *[F.col(n).alias(f"upper_{n}") for n in names]
    )
    return near.join(above, ["set_id", "upper"], "left").select(
        "set_id", "block", *[F.coalesce(F.col(n), F.col(f"upper_{n}")).alias(n) for n in names]
    )


# The four lookups work on words. The words that probes fall into are few and
# distinct; for them the neighbourhood is found, and each probe then reads its
# answer off its word or takes that of the neighbourhood.


def _probe_words(probes: DataFrame, at: Column) -> DataFrame:
    """``at`` an expression of ``word_ix``: the place of the word a probe falls into."""
    word_ix = bits.word_index(F.col("from_bit").cast("bigint")).alias("word_ix")
    return probes.select("set_id", word_ix).select("set_id", at.alias("from_bit"))


def _answer(probes: DataFrame, near: DataFrame, answer: Column, name: str) -> DataFrame:
    """``answer`` for every row of ``probes``, from ``near`` by word."""
    keyed = probes.withColumn("word_ix", bits.word_index(F.col("from_bit").cast("bigint")))
    return lookup(keyed, near, ["set_id", "word_ix"]).select(*probes.columns, answer.alias(name))


def _own_word() -> Column:
    return F.coalesce(F.col("word"), bits.long_lit(0))


def _position() -> Column:
    return bits.word_position(F.col("from_bit").cast("bigint"))


def _first_of(word: Column) -> Column:
    return F.shiftleft("word_ix", bits.WORD_SHIFT) + bits.trailing_zeros(word)


def _last_of(word: Column) -> Column:
    return F.shiftleft("word_ix", bits.WORD_SHIFT) + bits.width(word) - 1


def _nearest_set(members: DataFrame, probes: DataFrame, forward: bool, block_shift: int, name: str) -> DataFrame:
    end_of = _first_of if forward else _last_of
    words = pack(members)
    points = words.select(
        "set_id", F.col("word_ix").alias("bit"), end_of(F.col("word")).alias("found"), "word"
    )
    near = asof(points, _probe_words(probes, F.col("word_ix")), ["found"], forward, block_shift, "word", WORD_IX_BITS)
    reach = bits.from_position if forward else bits.up_to_position
    inside = _own_word().bitwiseAND(reach(_position()))
    answer = F.when(inside != 0, end_of(inside)).otherwise(
        F.coalesce(F.col("found"), bits.long_lit(-1))
    )
    return _answer(probes, near.withColumnRenamed("from_bit", "word_ix"), answer, name)


def next_set(members: DataFrame, probes: DataFrame, block_shift: int = BLOCK_SHIFT) -> DataFrame:
    """Smallest member at or after ``from_bit``, -1 if there is none."""
    return _nearest_set(members, probes, True, block_shift, "next_set")


def previous_set(members: DataFrame, probes: DataFrame, block_shift: int = BLOCK_SHIFT) -> DataFrame:
    """Largest member at or before ``from_bit``, -1 if there is none."""
    return _nearest_set(members, probes, False, block_shift, "previous_set")


def _runs_at(members: DataFrame, probes: DataFrame, at_end: bool, block_shift: int) -> DataFrame:
    """``(set_id, word_ix, word, run_start, run_end)`` for the words that probes fall into:
    the last run that starts at or before the end (or else the start) of the word."""
    words = pack(members)
    # A run within a word shows in the word itself.
    points = runs_of_words(words, block_shift, at_word_borders=True).select(
        "set_id", F.col("run_start").alias("bit"), "run_start", "run_end"
    )
    edge = F.shiftleft("word_ix", bits.WORD_SHIFT) + F.lit(bits.WORD_BITS - 1 if at_end else 0)
    near = asof(points, _probe_words(probes, edge), ["run_start", "run_end"], False, block_shift)
    return near.select("set_id", bits.word_index(F.col("from_bit")).alias("word_ix"), "run_start", "run_end").join(
        words, ["set_id", "word_ix"], "left"
    )


def _whole_words(capacity: int) -> int:
    return -(-capacity // bits.WORD_BITS) * bits.WORD_BITS


def next_clear(
    members: DataFrame, probes: DataFrame, capacity: int | None = None, block_shift: int = BLOCK_SHIFT
) -> DataFrame:
    """Smallest non-member at or after ``from_bit``.

    With a ``capacity`` (rounded up to whole words) the answer is -1 where no
    free position is left below it.
    """
    inside = F.bitwise_not(_own_word()).bitwiseAND(bits.from_position(_position()))
    # Without a free position in the word, a run covers the end of the word.
    free = F.when(inside != 0, _first_of(inside)).otherwise(F.col("run_end") + 1)
    if capacity is not None:
        free = F.when(free < F.lit(_whole_words(capacity)), free).otherwise(bits.long_lit(-1))
    return _answer(probes, _runs_at(members, probes, True, block_shift), free, "next_clear")


def previous_clear(
    members: DataFrame, probes: DataFrame, capacity: int | None = None, block_shift: int = BLOCK_SHIFT
) -> DataFrame:
    """Largest non-member at or before ``from_bit``, -1 if there is none.

    A probe at or past the ``capacity`` is free itself.
    """
    from_bit = F.col("from_bit").cast("bigint")
    inside = F.bitwise_not(_own_word()).bitwiseAND(bits.up_to_position(_position()))
    free = F.when(inside != 0, _last_of(inside)).otherwise(F.col("run_start") - 1)
    if capacity is not None:
        free = F.when(from_bit >= F.lit(_whole_words(capacity)), from_bit).otherwise(free)
    free = F.when(from_bit < 0, bits.long_lit(-1)).otherwise(free)
    return _answer(probes, _runs_at(members, probes, False, block_shift), free, "previous_clear")


def runs(members: DataFrame, block_shift: int = BLOCK_SHIFT) -> DataFrame:
    """``(set_id, run_start, run_end)``: maximal runs of consecutive members."""
    return runs_of_words(pack(members), block_shift)


def runs_of_words(
    words: DataFrame, block_shift: int = BLOCK_SHIFT, at_word_borders: bool = False
) -> DataFrame:
    """Runs of packed sets; with ``at_word_borders`` only those that touch a word border.

    Runs are read off each word with bit operations, joined within blocks by a
    window, and only the runs that touch a block border (at most two per
    block) are joined across blocks, level by level.
    """
    pieces = _word_runs(words)
    if at_word_borders:
        pieces = pieces.where(
            (bits.word_position(F.col("run_start")) == 0)
            | (bits.word_position(F.col("run_end")) == bits.WORD_BITS - 1)
        )
    found, shift = [], block_shift
    # Runs that touch the border of a block, two at most, go on to the next level.
    while shift <= block_shift + LEVEL_SHIFT:
        block = F.shiftright("run_start", shift).alias("block")
        joined = _join_runs(pieces.select("*", block), ["set_id", "block"]).select("set_id", "run_start", "run_end")
        mask = bits.long_lit((1 << shift) - 1)
        at_border = (F.col("run_start").bitwiseAND(mask) == 0) | (F.col("run_end").bitwiseAND(mask) == mask)
        found.append(joined.where(~at_border))
        pieces = joined.where(at_border)
        shift += LEVEL_SHIFT
    # What is left of a set are the runs at the borders of its largest blocks.
    found.append(_join_runs(pieces, ["set_id"]).select("set_id", "run_start", "run_end"))
    return reduce(DataFrame.unionByName, found)


def _word_runs(words: DataFrame) -> DataFrame:
    """Runs within each word, as if its neighbours were empty."""
    word, position = F.col("word"), F.col("position")
    starts = word.bitwiseAND(F.bitwise_not(F.shiftleft("word", 1)))
    length = bits.trailing_ones(bits.shift_right(word, position))
    start = F.shiftleft("word_ix", bits.WORD_SHIFT) + position
    return (
        words.where(word != 0)
        .select("set_id", "word_ix", "word", starts.alias("starts"), F.explode(bits.positions()).alias("position"))
        .where(bits.has_bit(F.col("starts"), position))
        .select("set_id", start.alias("run_start"), (start + length - 1).alias("run_end"))
    )


def _join_runs(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Join pieces that follow each other without a gap."""
    order = Window.partitionBy(*keys).orderBy("run_start")
    gap = F.coalesce(F.lag("run_end").over(order) + 1 != F.col("run_start"), F.lit(True))
    island = F.sum(F.col("gap").cast("bigint")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        pieces.withColumn("gap", gap)
        .withColumn("island", island)
        .groupBy(*keys, "island")
        .agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))
    )
