"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticework.llm import (
    ann,
    chat,
    decontaminate,
    host_rules,
    merkle,
    mixing,
    packing,
    periodic,
    quality,
    simhash,
    substring,
    token_files,
    toxicity,
)
from latticework.session import scratch_dir

# A vocabulary of the public tokenizers, and the ids that end a document.
VOCABULARY, PACKED_END, FILED_END = "word_bpe_49k.json", 2, 1

# The mixture: half as much again as the documents have, more of the smaller languages.
DOMAINS = {"web": 0.5, "books": 0.2, "code": 0.15, "news": 0.15, "other": 0.05}
LANGUAGES = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
MIXTURE = [mixing.Level("domain", DOMAINS), mixing.Level("lang", LANGUAGES, 0.05), mixing.Level("source")]
BUDGET = 1.5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def ship(spark: SparkSession) -> None:
    """Lets Python workers find the package where the driver found it."""
    known = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [root, known.get("PYTHONPATH")]))


def query(oracle: str | None = None):
    def register(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle:
            ORACLES[function.__name__] = oracle
        return run

    return register


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    """
    WITH words AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), windows AS (
      SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS passage
      FROM words, LATERAL unnest(generate_series(1, len(w) - 49)) AS t(p)
    ), repeated AS (
      SELECT doc_id, p
      FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY passage) AS least FROM windows)
      WHERE least < doc_id
    ), gone AS (
      SELECT DISTINCT doc_id, q FROM repeated, LATERAL unnest(generate_series(p, p + 49)) AS t(q)
    ), kept AS (
      SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY q) AS kept
      FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM words)
      ANTI JOIN gone USING (doc_id, q)
      GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
      CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
    """
)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query()
def op5_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary(), PACKED_END)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op10_token_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(), FILED_END)
    return token_files.checksums(token_files.read_tokens(spark, path))


_HOST_RULES = ("short", "repeats", "symbols", "lines")


def _prior_sql(rule: str) -> str:
    mean = f"sum(f_{rule}) / sum(n)"
    chance = f"{mean} * (1 - {mean}) * (count(*) - 1) / sum(n)"
    variance = f"greatest(sum(f_{rule} * f_{rule} / n) / sum(n) - {mean} * {mean} - {chance}, 1e-12)"
    return f"{mean} AS m_{rule}, least(greatest({mean} * (1 - {mean}) / {variance} - 1, 1.0), 10000.0) AS w_{rule}"


def _refused_sql(rule: str) -> str:
    bound = f"r_{rule} - 2 * sqrt(r_{rule} * (1 - r_{rule}) / (n + w_{rule} + 1))"
    return f"(r_{rule} > 0.5 OR r_{rule} >= 0.1 AND {bound} > 3 * m_{rule})"


@query(
    f"""
    WITH words AS (
      SELECT doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents
    ), windows AS (
      SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, array_to_string(w[p:p + 4], ' ')) AS times
      FROM words, LATERAL unnest(generate_series(1, len(w) - 4)) AS t(p)
    ), repeated AS (
      SELECT doc_id, count(DISTINCT q) AS n_repeat_words
      FROM windows, LATERAL unnest(generate_series(p, p + 4)) AS t(q)
      WHERE times > 1 GROUP BY doc_id
    ), lines AS (
      SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
    ), counted AS (
      SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
    ), judged AS (
      SELECT *, n_words < 10 AS short, 100 * n_repeat_words > 20 * n_words AS repeats,
        5 * n_symbols > word_chars AS symbols, 2 * n_dup_lines > n_words AS lines
      FROM counted
    ), hosts AS (
      SELECT source, CAST(count(*) AS DOUBLE) AS n,
        {", ".join(f"CAST(sum(CAST({r} AS INT)) AS DOUBLE) AS f_{r}" for r in _HOST_RULES)}
      FROM judged GROUP BY source
    ), prior AS (
      SELECT {", ".join(map(_prior_sql, _HOST_RULES))} FROM hosts
    ), rates AS (
      SELECT *, {", ".join(f"(f_{r} + w_{r} * m_{r}) / (n + w_{r}) AS r_{r}" for r in _HOST_RULES)} FROM hosts, prior
    ), verdicts AS (
      SELECT source, NOT ({" OR ".join(map(_refused_sql, _HOST_RULES))}) AS host_ok FROM rates
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      short OR repeats AS base_failed, NOT (short OR repeats) AND host_ok AS kept
    FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
    """
)
def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), *host_rules.COUNTS, "base_failed", "kept")


@query()
def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query()
def op6_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, scorer).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query(
    """
    WITH turns AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), formatted AS (
      SELECT *, '<|turn|>' || role || '<|text|>' || regexp_replace(
        regexp_replace(text, '\\\\', '\\\\\\\\', 'g'),
        '(<)(\\||/?s>)|(\\[)(/?(?:INST|SYS)\\])|(<)(</?SYS>>)', '\\1\\3\\5\\\\\\2\\4\\6', 'g') || '<|end|>' AS written
      FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, written)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, written) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(length(written)) AS BIGINT) AS formatted_chars, CAST(0 AS BIGINT) AS expanded_tokens
    FROM formatted GROUP BY conv_id
    """
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.sql(
        f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '{control}' AS text "
        f"UNION ALL SELECT -1L, 1L, 'assistant', '{control}'"
    )
    chats = chat.format_chats(turns.unionByName(more), parts="text")
    loss = chat.loss_text(F.col("formatted"))
    read = F.array_join(F.transform(chat.parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size(chat.parsed(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(read, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "expanded_tokens",
    )


@query()
def op9_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _weight_sql(level: mixing.Level) -> str:
    if level.weights is None:
        return "CAST(sum(supply) AS DOUBLE)"
    cases = " ".join(f"WHEN {level.column} = '{v}' THEN CAST({w} AS DOUBLE)" for v, w in level.weights.items())
    return f"CASE {cases} ELSE CAST({level.default} AS DOUBLE) END"


_ABLE_SQL = " AND ".join(f"{_weight_sql(level)} > 0" for level in MIXTURE if level.weights is not None)


def _level_sql(depth: int) -> str:
    path = [level.column for level in MIXTURE[: depth + 1]]
    parent, column, upper = path[:-1], path[-1], f"level{depth - 1}"
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM {upper}.{c}" for c in parent)
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"{by} ORDER BY capacity / weight, {column} NULLS FIRST"
    return f"""
    nodes{depth} AS (
      SELECT {', '.join(path)}, sum(supply) AS supply,
        sum(CASE WHEN {_ABLE_SQL} THEN supply ELSE 0 END) * {mixing.MAX_EPOCHS} AS capacity,
        {_weight_sql(MIXTURE[depth])} AS weight
      FROM leaves WHERE supply > 0 GROUP BY {', '.join(path)}
    ), given{depth} AS (
      SELECT n.*, {f"{upper}.given" if parent else "CAST(floor(CAST(1.5 AS DOUBLE) * total) AS DOUBLE)"} AS given
      FROM nodes{depth} n, {upper if parent else "(SELECT sum(supply) AS total FROM leaves)"}
      WHERE weight > 0 {"AND " + same if parent else ""}
    ), filled{depth} AS (
      SELECT *, (given - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fill
      FROM given{depth}
    ), level{depth} AS (
      SELECT {', '.join(path)}, supply, least(CAST(capacity AS DOUBLE), weight * max(fill) OVER ({by})) AS given
      FROM filled{depth}
    )"""


_NUMBER = "TRY_CAST(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS INT) % 4"


@query(
    f"""
    WITH units AS (
      SELECT coalesce(CASE {_NUMBER} WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' WHEN 3 THEN 'news' END,
          'other') AS domain, lang, source, doc_id,
        CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS BIGINT) AS tokens
      FROM documents GROUP BY ALL
    ), leaves AS (
      SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS supply FROM units GROUP BY ALL
    ), {", ".join(_level_sql(d) for d in range(len(MIXTURE)))},
    targets AS (
      SELECT domain, lang, source, CAST(floor(CAST(floor(given + 1e-6) AS BIGINT) / supply) AS BIGINT) AS whole,
        CAST(floor(given + 1e-6) AS BIGINT) % CAST(supply AS BIGINT) AS rest
      FROM level2
    ), ends AS (
      SELECT u.*, coalesce(whole, 0) AS whole, coalesce(rest, 0) AS rest, sum(tokens) OVER (
        PARTITION BY u.domain, u.lang, u.source
        ORDER BY md5('{mixing.SEED}:' || coalesce(whole, 0) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id
        ROWS UNBOUNDED PRECEDING) AS upto
      FROM units u LEFT JOIN targets t ON u.domain IS NOT DISTINCT FROM t.domain
        AND u.lang IS NOT DISTINCT FROM t.lang AND u.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, domain, lang, source, tokens,
      CAST(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM ends
    """
)
def op8_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", mixing.number_domain().alias("domain"), "lang", "source", mixing.word_tokens().alias("n_tokens")
    )
    return mixing.copies(docs, MIXTURE, budget=BUDGET).select("doc_id", "domain", "lang", "source", "tokens", "copies")


def _with_periodic_tail(doc_id, text):
    """The words of some texts, chosen by the CRC-32 of the id, from a position on as repeats of what starts there."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0)
    crc = F.crc32(doc_id.cast("string"))
    n, g = F.size(words), F.floor(crc / 10)
    at = (g % n).cast("int")
    period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
    times = F.ceil((n - at) / period).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, at + 1, period), times))
    planted = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), at), tail), F.lit(1), n), " ")
    return F.when((crc % 10 == 0) & (n > 0), planted).otherwise(text)


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", _with_periodic_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    best = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-best.less * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _siblings_sql(nodes: str) -> str:
    run = "OVER (PARTITION BY source, level, ix // 3 ORDER BY ix ROWS BETWEEN"
    return f"""
      SELECT source, level, ix,
        coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
      FROM {nodes} WHERE n > 1"""


def _nodes_sql(first: str, nodes: str) -> str:
    return f"""
      {first} UNION ALL
      SELECT source, level + 1, ix // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY ix))
      FROM {nodes} WHERE n > 1 GROUP BY source, level, ix // 3, n"""


def _fold_sql(first: str, fold: str, siblings: str) -> str:
    return f"""
      {first} UNION ALL
      SELECT f.leaf_no, f.source, f.level + 1, f.ix // 3, (f.n + 2) // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
      FROM {fold} f JOIN {siblings} s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.level AND f.ix = s.ix
      WHERE f.n > 1"""


@query(
    f"""
    WITH RECURSIVE steps AS (
      SELECT list(v ORDER BY i) AS steps FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS t(i))
    ), crc AS (
      SELECT *, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS crc
      FROM documents, steps
    ), leaves AS (
      SELECT row_number() OVER () AS leaf_no, doc_id, source, {_leaf_sql("text")} AS leaf,
        CASE WHEN crc % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS claimed
      FROM crc
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ix,
        count(*) OVER (PARTITION BY source) AS n
      FROM leaves
    ), nodes AS ({_nodes_sql("SELECT source, 0 AS level, ix, n, leaf AS h FROM numbered", "nodes")}
    ), subroots AS (
      SELECT source AS grp, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS ix, count(*) OVER () AS n
      FROM nodes WHERE n = 1
    ), upper_nodes AS ({_nodes_sql("SELECT 'all' AS source, 0 AS level, ix, n, h FROM subroots", "upper_nodes")}
    ), siblings AS ({_siblings_sql("nodes")}
    ), upper_siblings AS ({_siblings_sql("upper_nodes")}
    ), folds AS ({_fold_sql(
        "SELECT leaf_no, source, 0 AS level, ix, n, claimed AS h, '' AS proof FROM numbered", "folds", "siblings")}
    ), upper_folds AS ({_fold_sql(
        "SELECT leaf_no, 'all' AS source, 0 AS level, s.ix, s.n, f.h, f.proof FROM folds f JOIN subroots s "
        "ON f.source IS NOT DISTINCT FROM s.grp WHERE f.n = 1", "upper_folds", "upper_siblings")}
    )
    SELECT doc_id, leaf, s.h AS subroot, u.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root,
      f.h = u.h AS verified
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.grp
    JOIN (SELECT * FROM upper_folds WHERE n = 1) f ON l.leaf_no = f.leaf_no, (SELECT h FROM upper_nodes WHERE n = 1) u
    """
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.prove(merkle.manifest(merkle.document_leaves(table(spark, sf_dir, "documents"))))
    return proved.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_CASES = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), {_CASES}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    f"""
    WITH item_words AS (
      SELECT item_id, {_WORDS_SQL} AS w FROM benchmark
    ), windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p:p + 9], ' ') AS passage
      FROM item_words, LATERAL unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(p) WHERE len(w) > 0
    ), sizes AS (
      SELECT DISTINCT size FROM windows
    ), words AS (
      SELECT doc_id, {_WORDS_SQL} AS w FROM documents
    ), stretches AS (
      SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS passage
      FROM words, sizes, LATERAL unnest(generate_series(1, len(w) - size + 1)) AS t(p)
    ), found AS (
      SELECT doc_id, item_id, size, p FROM stretches JOIN windows USING (size, passage)
    ), hits AS (
      SELECT doc_id, count(DISTINCT q) AS n_hit FROM found, LATERAL unnest(generate_series(p, p + size - 1)) AS t(q)
      GROUP BY doc_id
    ), items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """
)
def op13_suffix_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
