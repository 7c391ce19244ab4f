"""Sets of non-negative integers, stored as tables.

Member form: ``(set_id, bit bigint)``. Packed form: ``(set_id, word_ix bigint,
word bigint)`` with at most one row per word; a word that is absent is empty.

Everything groups on ``(set_id, word_ix)``, so one set that holds most of the
data is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticework.functions.arrays import each
from latticework.functions import bits
from latticework.functions.hashing import HASH_SEED
from latticework.operators.joins import lookup
from latticework.operators.placing import begun
from latticework.session import materialize

KEYS = ["set_id", "word_ix"]

# Levels on which the ends of a range are masked; beyond, it is cut into whole units.
_EDGE_LEVELS = 3


def masks(members: DataFrame) -> DataFrame:
    """One single-bit word per input row."""
    bit = F.col("bit").cast("bigint")
    return members.select(
        "set_id", bits.word_index(bit).alias("word_ix"), bits.bit_mask(bit).alias("word")
    )


def _merge_words(words: DataFrame) -> DataFrame:
    return words.groupBy(*KEYS).agg(F.bit_or("word").alias("word"))


def pack(members: DataFrame) -> DataFrame:
    """Build sets from any number of (possibly repeated) members."""
    return _merge_words(masks(members))


def bounded(words: DataFrame, capacity: int) -> DataFrame:
    """``words``, failing at run time on a member at or past ``capacity`` (rounded up to
    whole words)."""
    n_words = -(-capacity // bits.WORD_BITS)
    outside = (F.col("word_ix") >= F.lit(n_words)) & (F.col("word") != 0)
    message = F.lit(f"a member lies outside the capacity of {capacity} bits")
    word = F.when(outside, F.raise_error(message).cast("bigint")).otherwise(F.col("word"))
    return words.select(*KEYS, word.alias("word"))


def unpack(words: DataFrame) -> DataFrame:
    """Members of packed sets."""
    spread = words.where(F.col("word") != 0).select(
        "*", F.explode(bits.positions()).alias("position")
    )
    return spread.where(bits.has_bit(F.col("word"), F.col("position"))).select(
        "set_id",
        (F.shiftleft("word_ix", bits.WORD_SHIFT) + F.col("position")).alias("bit"),
    )


def merge(words: DataFrame, *others: DataFrame) -> DataFrame:
    """Union of any number of packed tables, set by set."""
    for other in others:
        words = words.unionByName(other)
    return _merge_words(words)


def align(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(set_id, word_ix, a, b)``: words of two packed tables side by side, 0 if absent."""
    zero = bits.long_lit(0)
    both = a.select(*KEYS, F.col("word").alias("a"), zero.alias("b")).unionByName(
        b.select(*KEYS, zero.alias("a"), F.col("word").alias("b"))
    )
    return both.groupBy(*KEYS).agg(F.bit_or("a").alias("a"), F.bit_or("b").alias("b"))


def _combine(a: DataFrame, b: DataFrame, word: Column) -> DataFrame:
    return align(a, b).select(*KEYS, word.alias("word")).where(F.col("word") != 0)


def set_or(a: DataFrame, b: DataFrame) -> DataFrame:
    return _combine(a, b, F.col("a").bitwiseOR(F.col("b")))


def set_and(a: DataFrame, b: DataFrame) -> DataFrame:
    return _combine(a, b, F.col("a").bitwiseAND(F.col("b")))


def set_xor(a: DataFrame, b: DataFrame) -> DataFrame:
    return _combine(a, b, F.col("a").bitwiseXOR(F.col("b")))


def set_andnot(a: DataFrame, b: DataFrame) -> DataFrame:
    return _combine(a, b, F.col("a").bitwiseAND(F.bitwise_not(F.col("b"))))


def intersects(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(set_id, intersects)`` for every set that occurs on either side."""
    common = F.col("a").bitwiseAND(F.col("b")) != 0
    return align(a, b).groupBy("set_id").agg(F.bool_or(common).alias("intersects"))


def _for_sets(found: DataFrame, sets: DataFrame | None, defaults: dict) -> DataFrame:
    """Complete per-set results by the sets of ``sets`` that have no member."""
    if sets is None:
        return found
    joined = sets.select("set_id").distinct().join(found, "set_id", "left")
    return joined.select(
        "set_id", *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()]
    )


def cardinality(words: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """``(set_id, cardinality, is_empty)``."""
    found = words.groupBy("set_id").agg(
        F.sum(F.bit_count("word").cast("bigint")).alias("cardinality")
    )
    return _for_sets(found, sets, {"cardinality": 0}).withColumn(
        "is_empty", F.col("cardinality") == 0
    )


def logical_length(words: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """``(set_id, logical_length)``: highest member plus one, 0 for an empty set."""
    end = F.shiftleft("word_ix", bits.WORD_SHIFT) + bits.width(F.col("word"))
    found = words.where(F.col("word") != 0).groupBy("set_id").agg(
        F.max(end).alias("logical_length")
    )
    return _for_sets(found, sets, {"logical_length": 0})


def get(words: DataFrame, probes: DataFrame) -> DataFrame:
    """``probes`` (``set_id, bit, ...``) with the boolean column ``is_set``."""
    keyed = probes.withColumn("word_ix", bits.word_index(F.col("bit").cast("bigint")))
    hit = bits.has_bit(F.col("word"), bits.word_position(F.col("bit").cast("bigint")))
    return lookup(keyed, words.select(*KEYS, "word"), KEYS).select(
        *probes.columns, F.coalesce(hit, F.lit(False)).alias("is_set")
    )


def set_range(words: DataFrame, ranges: DataFrame) -> DataFrame:
    """Set all bits of ``ranges`` (``set_id, from_bit, to_bit``, end exclusive).

    A range becomes a head and a tail mask on words, on groups of 64 words and on
    groups of 4,096 words, and whole units of 262,144 bits in between. Equal pieces of
    overlapping ranges are merged before they are expanded, so long and heavily
    overlapping ranges cost no more than what they cover.
    """
    spans = ranges.select(
        "set_id",
        F.col("from_bit").cast("bigint").alias("lo"),
        F.col("to_bit").cast("bigint").alias("hi"),
    ).where(F.col("lo") < F.col("hi"))
    low, high = F.col("lo"), F.col("hi")
    edges: list[Column] = []
    for level in range(_EDGE_LEVELS):
        edges += _edge_masks(low, high, level)
        # What is left between the edges, in units of the next level.
        low = F.shiftright(low + F.lit(bits.WORD_BITS - 1), bits.WORD_SHIFT)
        high = F.shiftright(high, bits.WORD_SHIFT)
    whole_word = F.when(low < high, bits.long_lit(bits.ALL_ONES)).otherwise(bits.long_lit(0))
    whole = _piece(_EDGE_LEVELS, low, high - 1, whole_word)
    pieces = (
        spans.select("set_id", F.explode(F.array(*edges, whole)).alias("piece"))
        .select("set_id", "piece.*")
        .where(F.col("word") != 0)
        .select("set_id", "level", "word", each(F.sequence("first", "last")).alias("word_ix"))
        .groupBy("set_id", "level", "word_ix")
        .agg(F.bit_or("word").alias("word"))
    )
    return merge(words.select(*KEYS, "word"), _expand(pieces))


def _piece(level: int, first: Column, last: Column, word: Column) -> Column:
    return F.struct(
        F.lit(level).alias("level"), first.alias("first"), last.alias("last"), word.alias("word")
    )


def _edge_masks(low: Column, high: Column, level: int) -> list[Column]:
    """The masked words at both ends of ``[low, high)``; words in between are left out.

    An aligned end gives no mask, as its word belongs to the next level; where
    both ends fall into one word the two masks are cut down to what they share.
    """
    first = bits.word_index(low)
    last = bits.word_index(high)
    ones = bits.long_lit(bits.ALL_ONES)
    from_low = bits.shift_left(ones, bits.word_position(low))
    below_high = F.bitwise_not(bits.shift_left(ones, bits.word_position(high)))
    low_cut = bits.word_position(low) != 0
    high_cut = bits.word_position(high) != 0
    none = bits.long_lit(0)
    same = first == last
    head = (
        F.when(low >= high, none)
        .when(same, from_low.bitwiseAND(below_high))
        .when(low_cut, from_low)
        .otherwise(none)
    )
    tail = F.when((low >= high) | same, none).when(high_cut, below_high).otherwise(none)
    return [_piece(level, first, first, head), _piece(level, last, last, tail)]


def _expand(pieces: DataFrame) -> DataFrame:
    """Words of pieces: a set bit of level ``n`` stands for ``64 ** (n - 1)`` full words,
    and a piece of the last level for as many as a bit of it."""
    level, position, offset = F.col("level"), F.col("position"), F.col("offset")
    by_bit = (level >= 1) & (level < _EDGE_LEVELS)
    # Words of level 0 and whole units go on as one row, without a position.
    bit_rows = pieces.select(
        "*", F.explode(F.when(by_bit, bits.positions()).otherwise(F.array(F.lit(-1)))).alias("position")
    ).where((position < 0) | bits.has_bit(F.col("word"), F.greatest(position, F.lit(0))))
    unit = F.when(position < 0, F.col("word_ix")).otherwise(
        F.shiftleft("word_ix", bits.WORD_SHIFT) + position
    )
    spans = [F.sequence(F.lit(0), F.lit(bits.WORD_BITS ** max(n - 1, 0) - 1)) for n in range(_EDGE_LEVELS + 1)]
    offsets = spans[0]
    for n in range(2, _EDGE_LEVELS + 1):
        offsets = F.when(level == n, spans[n]).otherwise(offsets)
    shift = (F.greatest(level - 1, F.lit(0)) * F.lit(bits.WORD_SHIFT)).cast("int")
    return bit_rows.select("set_id", "level", "word", unit.alias("unit"), F.explode(offsets).alias("offset")).select(
        "set_id",
        (bits.shift_left(F.col("unit"), shift) + offset).alias("word_ix"),
        F.when(level == 0, F.col("word")).otherwise(bits.long_lit(bits.ALL_ONES)).alias("word"),
    )


def update(members: DataFrame, updates: DataFrame) -> DataFrame:
    """Members after a list of updates ``(set_id, bit, value boolean, seq bigint)``.

    The update with the highest ``seq`` decides about a bit: true sets it, false
    clears it. A null ``bit`` clears the whole set at that point. ``seq`` is
    unique per set.
    """
    before = bits.long_lit(-(1 << 63))
    writes = members.select(
        "set_id", F.col("bit").cast("bigint").alias("bit"), F.lit(True).alias("value"), before.alias("seq")
    ).unionByName(
        updates.where(F.col("bit").isNotNull()).select(
            "set_id", F.col("bit").cast("bigint").alias("bit"), "value", F.col("seq").cast("bigint").alias("seq")
        )
    )
    latest = (
        writes.groupBy("set_id", "bit")
        .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq"))
        .where("value")
    )
    clears = (
        updates.where(F.col("bit").isNull())
        .groupBy("set_id")
        .agg(F.max("seq").cast("bigint").alias("clear_seq"))
    )
    return (
        lookup(latest, clears, ["set_id"])
        .where(F.col("clear_seq").isNull() | (F.col("seq") > F.col("clear_seq")))
        .select("set_id", "bit")
    )


def flip(words: DataFrame, flips: DataFrame) -> DataFrame:
    """Packed sets after flipping every row of ``flips`` (``set_id, bit``) once."""
    return (
        words.select(*KEYS, "word")
        .unionByName(masks(flips))
        .groupBy(*KEYS)
        .agg(F.bit_xor("word").alias("word"))
        .where(F.col("word") != 0)
    )


def hash_code(words: DataFrame) -> DataFrame:
    """``(set_id, hash_code)``: signed 32-bit hash of a whole set."""
    weighted = bits.wrapping_multiply(F.col("word"), F.col("word_ix") + bits.long_lit(1))
    code = F.col("mix").bitwiseXOR(bits.long_lit(HASH_SEED))
    return (
        words.groupBy("set_id")
        .agg(F.bit_xor(weighted).alias("mix"))
        .select("set_id", bits.fold_to_int(code).alias("hash_code"))
    )


def signatures(words: DataFrame) -> DataFrame:
    """``(set_id, signature)``: a digest over the whole content of a set, whatever its order.

    The SHA-256 of each word with its index is cut in four parts of 60 bits, and these are summed; the
    sums and the number of words are the signature. They combine on the map side, so the words of a
    set never meet.
    """
    entry = F.sha2(F.concat_ws(":", F.hex("word_ix"), F.hex("word")), 256)
    parts = [
        F.conv(F.substring("entry", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"part_{i}") for i in range(4)
    ]
    sums = [F.sum(f"part_{i}").cast("string").alias(f"sum_{i}") for i in range(4)]
    return (
        words.where(F.col("word") != 0)
        .select("set_id", entry.alias("entry"))
        .select("set_id", *parts)
        .groupBy("set_id")
        .agg(*sums, F.count("*").cast("string").alias("n"))
        .select("set_id", F.concat_ws(":", "n", *[f"sum_{i}" for i in range(4)]).alias("signature"))
    )


def equal_groups(words: DataFrame, signed: DataFrame | None = None) -> DataFrame:
    """``(set_id, leader, n_sets)``: sets of equal content share the smallest ``set_id``.

    Sets of one signature (``signed``, by default :func:`signatures`) are compared word by word: their words are
    aligned by group and place in one aggregation, and a group is one if each place has a word of every set,
    all the same. In a group that is not, each set is compared with the smallest, and those that differ are grouped anew
    among themselves, so two sets that only share a signature stay apart. No pairs are formed.
    """
    words = words.where(F.col("word") != 0).select("set_id", "word_ix", "word")
    left = signatures(words) if signed is None else signed
    found = None
    while True:
        leaders = left.groupBy("signature").agg(F.min("set_id").alias("leader"), F.count("*").alias("n_sets"))
        led = materialize(lookup(left, leaders, ["signature"], "inner"), "set-leaders")
        aligned = (
            lookup(words, led.where("n_sets > 1").select("set_id", "leader", "n_sets"), ["set_id"], "inner")
            .groupBy("leader", "n_sets", "word_ix")
            .agg(F.count("*").alias("n"), F.min("word").alias("least"), F.max("word").alias("most"))
        )
        mixed = aligned.where("n != n_sets OR least != most").select("leader").distinct()
        mixed = materialize(mixed.withColumn("mixed", F.lit(True)), "set-mixed")
        members = lookup(led.where("set_id != leader"), mixed, ["leader"], "inner")
        if mixed.isEmpty():
            same, different = led, None
        else:
            of_leaders = lookup(words, members.select(F.col("leader").alias("set_id")).distinct(), ["set_id"], "inner")
            sizes = of_leaders.groupBy(F.col("set_id").alias("leader")).agg(F.count("*").alias("n_leader"))
            of_leaders = of_leaders.select(F.col("set_id").alias("leader"), "word_ix", F.col("word").alias("other"))
            own = lookup(words, members.select("set_id", "leader"), ["set_id"], "inner")
            agreed = (
                lookup(own, of_leaders, ["leader", "word_ix"])
                .groupBy("set_id", "leader")
                .agg(F.count("*").alias("n"), F.count_if(F.col("word") == F.col("other")).alias("n_same"))
            )
            agreed = lookup(agreed, sizes, ["leader"]).select(
                "set_id", ((F.col("n") == F.col("n_same")) & (F.col("n") == F.col("n_leader"))).alias("same")
            )
            # Sets of other groups are the same as their leader.
            judged = materialize(lookup(led, agreed, ["set_id"]), "set-judged")
            same, different = judged.where("coalesce(same, true)"), judged.where("NOT same")
        same = same.select("set_id", "leader")
        found = same if found is None else found.unionByName(same)
        if different is None or different.isEmpty():
            break
        left = different.select("set_id", "signature")
    sizes = found.groupBy("leader").agg(F.count("*").alias("n_sets"))
    return lookup(found, sizes, ["leader"], "inner").select("set_id", "leader", "n_sets")


def _entries(words: DataFrame) -> DataFrame:
    """Words with ``entry``: their place and their members as text."""
    base = F.shiftleft("word_ix", bits.WORD_SHIFT)
    in_word = F.array_join(
        F.transform(bits.set_positions(F.col("word")), lambda p: (base + p).cast("string")), ", "
    )
    return words.where(F.col("word") != 0).withColumn("entry", F.struct("word_ix", in_word.alias("part")))


def _joined(entries: Column) -> Column:
    return F.array_join(F.sort_array(entries)["part"], ", ")


def to_text(words: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """``(set_id, text)`` in the form ``{1, 2, 5}``; the result is one cell per set."""
    found = (
        _entries(words)
        .groupBy("set_id")
        .agg(F.collect_list("entry").alias("entries"))
        .select("set_id", F.concat(F.lit("{"), _joined(F.col("entries")), F.lit("}")).alias("text"))
    )
    return _for_sets(found, sets, {"text": "{}"})


def to_text_segments(words: DataFrame, sets: DataFrame | None = None, words_per_segment: int = 1_024) -> DataFrame:
    """``(set_id, segment, start, text)``: the form of :func:`to_text` in ordered segments.

    For sets whose text is larger than a cell. A segment is the text of ``words_per_segment`` words by their place, with the
    bracket or comma before it; segments without members are left out. The texts of a set in the order of ``segment`` are its
    text form, and ``start`` is the number of characters before each. A segment is gathered alone, so no task
    holds a set. A set of ``sets`` without members has one segment, 0, of ``{}``.
    """
    if words_per_segment < 1:
        raise ValueError("words_per_segment must be at least 1")
    # A struct, as a null in it is equal to another.
    owner = F.struct("set_id").alias("owner")
    segment = F.call_function("div", F.col("word_ix").cast("long"), F.lit(words_per_segment)).alias("segment")
    parts = _entries(words).groupBy(owner, segment).agg(_joined(F.collect_list("entry")).alias("part"))
    # Read for the ends, the places and the texts.
    parts = materialize(parts, "text-segments")
    ends = parts.groupBy("owner").agg(F.min("segment").alias("first"), F.max("segment").alias("last"))
    opening = F.when(F.col("segment") == F.col("first"), F.lit("{")).otherwise(F.lit(", "))
    closing = F.when(F.col("segment") == F.col("last"), F.lit("}")).otherwise(F.lit(""))
    sized = lookup(parts.select("owner", "segment", F.length("part").alias("n")), ends, ["owner"], "inner")
    sized = sized.select("owner", "segment", opening.alias("opening"), closing.alias("closing"), "n")
    sized = sized.withColumn("size", F.col("n") + F.length("opening") + F.length("closing"))
    placed = lookup(sized, begun(sized, "owner", "segment", "size"), ["owner", "segment"], "inner")
    found = lookup(parts, placed, ["owner", "segment"], "inner").select(
        "owner.set_id", "segment", F.col("begun").alias("start"), F.concat("opening", "part", "closing").alias("text")
    )
    if sets is None:
        return found
    empty = sets.select("set_id").distinct().join(ends.select("owner.set_id"), "set_id", "left_anti")
    return found.unionByName(
        empty.select("set_id", F.lit(0).cast("long").alias("segment"), F.lit(0).cast("long").alias("start"), F.lit("{}").alias("text"))
    )
