"""Recovery of hashed values from a declared small domain and hints.

A record declares its alphabet, the length of its value and the SHA-256 of the
value. Each hint is the SHA-256 of a permutation of the alphabet minus one
symbol. Matching the hints against the enumerated permutations tells which
symbols are excluded; the value is then matched among all strings of the
declared length over the remaining symbols.

Record shape: ``(id, alphabet string, plen int, value_hash string, hints array<string>)``
with unique ``id``.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticework.functions.arrays import each
from latticework.functions.hashing import sha256_hex
from latticework.operators.joins import lookup
from latticework.session import BROADCAST_ROWS, materialize

# The last symbols of a permutation are placed in one step, by these templates.
_TEMPLATE_SYMBOLS = "12345"

# Candidates one task should enumerate.
ROWS_PER_TASK = 250_000

# Numbers that one row stands for until it is expanded: beginnings of permutations, and strings.
_PREFIXES_PER_BLOCK, _STRINGS_PER_BLOCK = 256, 16_384


def _symbols(text: Column) -> Column:
    return F.split(text, "")


def _spread(rows: DataFrame, total: int, *keys: str) -> DataFrame:
    """Spread started enumerations over as many tasks as the finished ones need."""
    parallelism = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(parallelism, -(-total // ROWS_PER_TASK)), *keys)


def _templates(n: int) -> Column:
    """All orderings of the first ``n`` template symbols, as a literal array."""
    orderings = itertools.permutations(_TEMPLATE_SYMBOLS[:n])
    return F.array(*[F.lit("".join(o)) for o in orderings])


def _digest(cand: Column) -> Column:
    """Digest of a candidate, declared not null: a nullable join key would be computed
    a second time for the null test in front of the join."""
    return F.coalesce(sha256_hex(cand), F.lit(""))


# Join hint for candidates too many to broadcast: Spark underestimates exploded rows, and a sorted join
# spills whatever their number.
SHUFFLED = "shuffle_merge"


def distinct_symbols(alphabet: Column) -> Column:
    """The alphabet with each symbol once, in its order."""
    return F.array_join(F.array_distinct(_symbols(alphabet)), "")


def n_permutations(alphabet: Column) -> Column:
    """Permutation candidates of an alphabet, as a double."""
    n = F.length(distinct_symbols(alphabet))
    # Factorials beyond 20 exceed a long; as doubles they go on, to infinity.
    beyond = F.aggregate(
        F.when(n > 20, F.sequence(F.lit(21), n)).otherwise(F.array().cast("array<int>")), F.lit(1.0), lambda a, i: a * i
    )
    return F.factorial(F.least(n, F.lit(20))).cast("double") * beyond


def n_strings(universe: Column, plen: Column) -> Column:
    """Strings of length ``plen`` over a universe, as a double."""
    return F.pow(F.length(universe), plen)


def _within(count: Column, limit: int | None) -> Column:
    return F.lit(True) if limit is None else count <= F.lit(float(limit))


def permutation_count(alphabets: DataFrame) -> int:
    """Number of permutation candidates of distinct alphabets."""
    distinct = alphabets.select("alphabet").distinct()
    return _whole(distinct.agg(F.sum(n_permutations(F.col("alphabet"))).alias("n")).first()["n"])


def _whole(count: float | None) -> int:
    """A count for planning; endless ones are as good as a very large one."""
    return int(min(count or 0, 1e18))


def _last_number(count: Column) -> Column:
    """Number of the last of ``count`` (a double) candidates; counts beyond a long end at its largest value."""
    return F.when(count < 9e18, count.cast("bigint") - 1).otherwise(F.lit(2**63 - 2))


def _blocks(ranges: DataFrame, first: Column, last: Column, width: int, total: int, *keys: str) -> DataFrame:
    """A row for each of the numbers ``first`` to ``last``, in the column ``number``.

    Blocks of ``width`` numbers are spread over the cluster as one row each and expanded there.
    """
    rows = ranges.withColumns({"block": first, "until": last}).where("block <= until")
    rows = rows.withColumn("block", F.explode(F.sequence("block", "until", F.lit(width).cast("bigint"))))
    end = F.least(F.col("block") + F.lit(width - 1), F.col("until"))
    rows = _spread(rows, total, *keys, "block")
    return rows.withColumn("number", each(F.sequence("block", end))).drop("block", "until")


def permutations_between(ranges: DataFrame, total: int | None = None) -> DataFrame:
    """``(alphabet, number, cand, excluded)``: the candidates that ``ranges (alphabet, first, last)`` ask for.

    The orderings of an alphabet of ``n`` distinct symbols are numbered from 0 in lexicographic order of the
    symbols' places in it, up to ``n! - 1``. Both ends of a range belong to it, and what lies outside is cut off;
    ranges that overlap give a candidate each. A null alphabet or end gives nothing.

    A number is read in the factorial number system, so any range is computed alone. Only the number of the
    symbols before the last five is read so, once for all orderings of these. Numbers are ``bigint``: of
    an alphabet of more than 20 symbols the first 2^63 candidates can be asked for.
    """
    if total is None:
        total = _whole(ranges.agg(F.sum(F.col("last").cast("double") - F.col("first") + 1).alias("n")).first()["n"])
    left, at_once = F.length("rest"), len(_TEMPLATE_SYMBOLS)
    tail = F.factorial(F.least(left, F.lit(at_once)))
    end = _last_number(n_permutations(F.col("alphabet")))
    rows = ranges.select(
        "alphabet",
        F.when(F.col("first") > 0, F.col("first").cast("bigint")).when(F.col("first") <= 0, F.lit(0)).alias("first"),
        F.when(F.col("last") < end, F.col("last").cast("bigint")).when(F.col("last") >= end, end).alias("last"),
        distinct_symbols(F.col("alphabet")).alias("rest"),
    ).where("alphabet IS NOT NULL AND first <= last")
    rows = rows.withColumn("tail", tail)
    whole = lambda a, b: F.call_function("div", a, b)
    begin, until = whole(F.col("first"), F.col("tail")), whole(F.col("last"), F.col("tail"))
    rows = _blocks(rows, begin, until, _PREFIXES_PER_BLOCK, total, "alphabet")

    def place(state: Column, step: Column) -> Column:
        rest, number = state["rest"], state["number"]
        # Orderings that begin alike; where these exceed a bigint the number picks the first symbol.
        alike = whole(F.factorial(F.length(rest) - 1), F.col("tail"))
        at = F.coalesce(whole(number, alike), F.lit(0)).cast("int")
        return F.struct(
            F.concat(state["cand"], F.substring(rest, at + 1, F.lit(1))).alias("cand"),
            F.concat(F.substring(rest, F.lit(1), at), F.substring(rest, at + 2, F.length(rest))).alias("rest"),
            F.coalesce(number % alike, number).alias("number"),
        )

    steps = F.when(left > at_once, F.sequence(F.lit(1), left - at_once)).otherwise(F.array().cast("array<int>"))
    begun = F.struct(F.lit("").alias("cand"), F.col("rest"), F.col("number"))
    rows = rows.withColumn("begun", F.aggregate(steps, begun, place)).select(
        "alphabet", "first", "last", "tail", "number", "begun.cand", "begun.rest"
    )
    templates = F.when(left == 1, _templates(1))
    for n in range(2, at_once + 1):
        templates = templates.when(left == n, _templates(n))
    ordered = F.expr(f"translate(template, substring('{_TEMPLATE_SYMBOLS}', 1, length(rest)), rest)")
    return (
        rows.select("*", F.posexplode_outer(templates).alias("at", "template"))
        .select("*", (F.col("number") * F.col("tail") + F.coalesce("at", F.lit(0))).alias("nth"), ordered.alias("ordered"))
        .where("nth BETWEEN first AND last")
        .select(
            "alphabet",
            F.col("nth").alias("number"),
            F.concat("cand", F.substring(F.col("ordered"), F.lit(1), left - 1)).alias("cand"),
            F.substring("ordered", -1, 1).alias("excluded"),
        )
    )


def permutations(
    alphabets: DataFrame,
    max_candidates: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """``(alphabet, cand, excluded)``: every ordering of every alphabet minus one symbol.

    A symbol that an alphabet repeats counts once. With ``max_candidates`` an alphabet that
    has more is left out; all others are enumerated. ``total`` is their number, if known.

    The candidates come by number (see :func:`permutations_between`): blocks of numbers are
    spread over the cluster, and rows stream through and are never held as a whole. An
    alphabet of ``n`` symbols gives ``n!`` rows.
    """
    alphabets = alphabets.where(_within(n_permutations(F.col("alphabet")), max_candidates))
    total = permutation_count(alphabets) if total is None else total
    ranges = alphabets.select("alphabet").distinct().select(
        "alphabet", F.lit(0).alias("first"), _last_number(n_permutations(F.col("alphabet"))).alias("last")
    )
    return permutations_between(ranges, total).drop("number")


def hashed_permutations(alphabets: DataFrame, **options) -> DataFrame:
    """``(alphabet, cand_hash, excluded)``."""
    return permutations(alphabets, **options).select(
        "alphabet", _digest(F.col("cand")).alias("cand_hash"), "excluded"
    )


def tuple_count(domains: DataFrame) -> tuple[int, int]:
    """(number of strings, longest length) over distinct ``(universe, plen)`` domains."""
    row = (
        domains.select("universe", "plen")
        .distinct()
        .agg(
            F.sum(n_strings(F.col("universe"), F.col("plen"))).alias("n"),
            F.max("plen").alias("m"),
        )
        .first()
    )
    return _whole(row["n"]), int(row["m"] or 0)


def tuples(
    domains: DataFrame,
    max_candidates: int | None = None,
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """``(universe, plen, cand)``: all strings of length ``plen`` over ``universe``,
    symbols may repeat. A domain of ``n`` symbols gives ``n ** plen`` rows; with
    ``max_candidates`` a domain that has more is left out."""
    domains = domains.where(_within(n_strings(F.col("universe"), F.col("plen")), max_candidates))
    total, longest = size or tuple_count(domains)
    rows = domains.select("universe", "plen").distinct().select(
        "universe", "plen", _symbols(F.col("universe")).alias("symbols"), F.lit("").alias("cand")
    )
    for depth in range(1, longest + 1):
        # A finished string passes through with an empty step.
        step = F.when(F.length("cand") < F.col("plen"), F.col("symbols")).otherwise(
            F.array(F.lit(""))
        )
        rows = rows.select(
            "universe", "plen", "symbols", "cand", each(step).alias("symbol")
        ).select("universe", "plen", "symbols", F.concat("cand", "symbol").alias("cand"))
        if depth == max(longest // 2, 1) and total > ROWS_PER_TASK:
            rows = _spread(rows, total, "universe", "plen", "cand")
    return rows.select("universe", "plen", "cand")


def hint_rows(records: DataFrame) -> DataFrame:
    """``(id, alphabet, hint_ix, hint_hash)``: one row per non-null hint, counted from 1."""
    # The outer form keeps Spark from testing the size of the array beforehand, which would
    # compute a derived hint array twice.
    return (
        records.select("id", "alphabet", F.posexplode_outer("hints").alias("ix", "hint_hash"))
        .where(F.col("hint_hash").isNotNull())
        .select("id", "alphabet", (F.col("ix") + 1).alias("hint_ix"), "hint_hash")
    )


def _hint_matches(
    hints: DataFrame,
    records: DataFrame,
    candidates: DataFrame | None,
    max_candidates: int | None,
    broadcast_rows: int,
) -> DataFrame:
    """``hints`` with the column ``excluded``, null where no candidate has the hash."""
    alphabets = records.groupBy("alphabet").agg(F.sum(F.size("hints").cast("bigint")).alias("hints"))
    if candidates is None:
        open_ = alphabets.where(_within(n_permutations(F.col("alphabet")), max_candidates))
        row = open_.agg(
            F.sum(n_permutations(F.col("alphabet"))).alias("n"), F.sum("hints").alias("h")
        ).first()
        total, n_hints = _whole(row["n"]), int(row["h"] or 0)
        candidates = hashed_permutations(records.select("alphabet"), max_candidates=max_candidates, total=total)
    else:
        n_hints = int(alphabets.agg(F.sum("hints")).first()[0] or 0)
        total = n_hints
        if n_hints > broadcast_rows:
            # Only candidates of the records' alphabets take part, and these are counted.
            candidates = candidates.join(alphabets.select("alphabet"), "alphabet", "left_semi")
            total = candidates.count()
    found = candidates.withColumnRenamed("cand_hash", "hint_hash")
    keys = ["alphabet", "hint_hash"]
    if total <= broadcast_rows and total < n_hints:
        # Few candidates: the records stream by and are not shuffled.
        return hints.join(F.broadcast(found), keys, "left")
    if n_hints <= broadcast_rows:
        # Few hints: the candidates stream by, and those asked for come back.
        wanted = hints.select(*keys).distinct()
        matched = found.join(F.broadcast(wanted), keys)
        return hints.join(F.broadcast(matched), keys, "left")
    return lookup(hints, found.hint(SHUFFLED), keys)


def match_hints(
    records: DataFrame,
    candidates: DataFrame | None = None,
    max_candidates: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, hint_ix, hint_hash, excluded)`` for every hint of every record.

    All hints are looked up in one pass over the candidates. The side to broadcast
    is chosen by its exact row count; if both are large the join is shuffled.
    """
    return _hint_matches(
        hint_rows(records), records, candidates, max_candidates, broadcast_rows
    ).select("id", "hint_ix", "hint_hash", "excluded")


def remaining_universe(
    records: DataFrame,
    candidates: DataFrame | None = None,
    max_candidates: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, alphabet, plen, value_hash, excluded array, universe string)`` per record.

    The excluded symbols of a record are gathered as a set, as large as its alphabet at
    most. A record without hints keeps its alphabet, each symbol once.
    """
    carried = ["id", "alphabet", "plen", "value_hash"]
    hints = records.select(*carried, F.explode_outer("hints").alias("hint_hash"))
    gone = (
        _hint_matches(hints, records, candidates, max_candidates, broadcast_rows)
        .groupBy(*carried)
        .agg(F.sort_array(F.collect_set("excluded")).alias("excluded"))
    )
    left = F.array_except(F.array_distinct(_symbols(F.col("alphabet"))), F.col("excluded"))
    return gone.select(*carried, "excluded", F.array_join(left, "").alias("universe"))


def recover(
    records: DataFrame,
    candidates: DataFrame | None = None,
    universes: DataFrame | None = None,
    max_candidates: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, value, status)``: ``value`` is null and ``status`` is ``unresolved``
    where no string of the remaining domain has the declared hash.

    ``max_candidates``, if given, is decided for each alphabet and each domain alone. A record
    whose alphabet or domain has more is ``refused``, and all others are solved.

    Records that share a domain share its enumeration. The remaining universes are
    read three times, so they are stored once, unless given as ``universes``.
    """
    if universes is None:
        universes = materialize(
            remaining_universe(records, candidates, max_candidates, broadcast_rows), "universes"
        )
    strings = n_strings(F.col("universe"), F.col("plen"))
    within = _within(strings, max_candidates)
    if candidates is None:
        within = within & _within(n_permutations(F.col("alphabet")), max_candidates)
    open_ = F.coalesce(within, F.lit(True))
    domains = universes.where(open_).select("universe", "plen").distinct()
    total, longest = tuple_count(domains)
    cands = tuples(domains, size=(total, longest)).withColumn("value_hash", _digest(F.col("cand")))
    keys = ["universe", "plen", "value_hash"]
    if total <= broadcast_rows:
        joined = universes.join(F.broadcast(cands), keys, "left")
    else:
        joined = lookup(universes, cands.hint(SHUFFLED), keys)
    status = F.when(~open_, F.lit("refused")).when(F.col("cand").isNull(), F.lit("unresolved"))
    value = F.when(open_, F.col("cand"))
    return joined.select("id", value.alias("value"), status.otherwise(F.lit("found")).alias("status"))


def strings_between(ranges: DataFrame, total: int) -> DataFrame:
    """``(universe, plen, number, cand)``: the strings ``first`` to ``last`` of ``ranges (universe, plen, first, last)``.

    The strings of a domain are numbered from 0, in the order of the symbols of its universe. A number is
    read to the base of their number, so any range is computed alone. ``total`` is the number of strings.
    """
    rows = _blocks(ranges, F.col("first"), F.col("last"), _STRINGS_PER_BLOCK, total, "universe", "plen")
    base = F.length("universe").cast("bigint")

    def digit(state: Column, step: Column) -> Column:
        at = (state["left"] % base).cast("int") + 1
        return F.struct(
            F.concat(F.substring(F.col("universe"), at, F.lit(1)), state["cand"]).alias("cand"),
            F.call_function("div", state["left"], base).alias("left"),
        )

    steps = F.when(F.col("plen") > 0, F.sequence(F.lit(1), F.col("plen"))).otherwise(F.array().cast("array<int>"))
    begun = F.struct(F.lit("").alias("cand"), F.col("number").alias("left"))
    return rows.select("universe", "plen", "number", F.aggregate(steps, begun, digit)["cand"].alias("cand"))


def recover_in_slices(
    records: DataFrame,
    candidates: DataFrame | None = None,
    universes: DataFrame | None = None,
    max_candidates: int | None = None,
    first_slice: int = 1_000_000,
    growth: int = 4,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, value, status, slice, n_slices)``: values and status as :func:`recover` gives them, without enumerating
    a domain beyond the slice that solves the last of its records.

    Each round takes the next slice of the strings of every domain that has an open record: ``first_slice`` strings
    of each, then ``growth`` times as many a round, so the rounds are few however large a domain is. ``slice`` is the
    round that found the value (from 1, null if none did), ``n_slices`` the rounds that the record's domain took
    part in. A record without a hash, length or universe is unresolved and keeps no domain open.

    What is open, and what a round found, is a stored table, so a lost executor repeats one round at most.
    """
    if universes is None:
        universes = materialize(
            remaining_universe(records, candidates, max_candidates, broadcast_rows), "universes"
        )
    strings = n_strings(F.col("universe"), F.col("plen"))
    within = _within(strings, max_candidates)
    if candidates is None:
        within = within & _within(n_permutations(F.col("alphabet")), max_candidates)
    allowed = F.coalesce(within, F.lit(True))
    keys = ["universe", "plen", "value_hash"]
    waiting = universes.where(allowed & F.col("value_hash").isNotNull()).select("id", *keys)
    spark = universes.sparkSession
    hits = spark.createDataFrame([], waiting.select("id").schema).selectExpr("id", "'' AS cand", "0 AS slice")
    ran = spark.createDataFrame([], "universe string, plen int, n_slices int")
    begin, width, number = 0, first_slice, 1
    while True:
        domains = waiting.select("universe", "plen").distinct().where(strings > F.lit(float(begin)))
        ranges = domains.select(
            "universe", "plen", F.lit(begin).cast("bigint").alias("first"),
            F.least(F.lit(begin + width - 1).cast("bigint"), _last_number(strings)).alias("last"),
        )
        ranges = materialize(ranges, f"domains-{number}")
        total = ranges.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0]
        if not total:
            break
        cands = strings_between(ranges, total).withColumn("value_hash", _digest(F.col("cand"))).drop("number")
        if total <= broadcast_rows:
            joined = waiting.join(F.broadcast(cands), keys)
        else:
            joined = lookup(waiting, cands.hint(SHUFFLED), keys, "inner")
        found = materialize(joined.select("id", "cand", F.lit(number).alias("slice")), f"slice-{number}")
        hits = hits.unionByName(found)
        ran = ran.unionByName(ranges.select("universe", "plen", F.lit(number).alias("n_slices")))
        begin, width, number = begin + width, width * growth, number + 1
        rest = waiting.where(strings > F.lit(float(begin))).join(found.select("id"), "id", "left_anti")
        waiting = materialize(rest.select("id", *keys), f"open-{number}")
    rounds = ran.groupBy("universe", "plen").agg(F.max("n_slices").alias("n_slices"))
    joined = universes.withColumn("allowed", allowed).join(hits, "id", "left")
    joined = lookup(joined, rounds, ["universe", "plen"])
    status = F.when(~F.col("allowed"), F.lit("refused")).when(F.col("slice").isNull(), F.lit("unresolved"))
    return joined.select(
        "id", F.col("cand").alias("value"), status.otherwise(F.lit("found")).alias("status"), "slice",
        F.when(F.col("allowed"), F.coalesce("n_slices", F.lit(0))).otherwise(F.lit(0)).alias("n_slices"),
    )
