import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from latticework.llm import mixing
from latticework.llm.mixing import Level

SCHEMA = "doc_id long, lang string, source string, n_tokens long"


def fill(budget, children):
    """Water-filling by rounds: children {name: (weight, capacity)}."""
    given, open_ = {}, {k for k, (w, _) in children.items() if w > 0}
    left = budget
    while open_:
        total = sum(children[k][0] for k in open_)
        full = {k for k in open_ if children[k][1] <= left * children[k][0] / total + 1e-9}
        if not full:
            given |= {k: left * children[k][0] / total for k in open_}
            break
        for k in full:
            given[k] = children[k][1]
        left -= sum(children[k][1] for k in full)
        open_ -= full
    return given


def brute(rows, weights, budget, max_epochs, seed):
    units = Counter()
    for i, lang, source, n in rows:
        units[(lang, source, i)] += n or 0
    supply = Counter()
    for (lang, source, _), n in units.items():
        supply[lang, source] += n
    total = sum(supply.values())
    langs = defaultdict(dict)
    for (lang, source), n in supply.items():
        if n:
            langs[lang][source] = n
    tops = fill(int(budget * total), {k: (weights.get(k, 0.0), sum(v.values()) * max_epochs) for k, v in langs.items()})
    target = {}
    for lang, b in tops.items():
        for source, t in fill(b, {s: (n, n * max_epochs) for s, n in langs[lang].items()}).items():
            target[lang, source] = int(t + 1e-6)
    out = {}
    for leaf in {u[:2] for u in units}:
        whole, rest = divmod(target.get(leaf, 0), supply[leaf]) if supply[leaf] else (0, 0)
        order = sorted(
            (hashlib.md5(f"{seed}:{whole}:{'' if u[2] is None else u[2]}".encode()).hexdigest(), u)
            for u in units if u[:2] == leaf
        )
        at = 0
        for _, u in order:
            at += units[u]
            out[u] = whole + (rest > 0 and at <= rest)
    return out


ROWS = [(i, ["en", "en", "en", "de", None][i % 5], f"s{i * i % 7}", (i * 37) % 90) for i in range(400)]
ROWS += [(3, "en", "s2", 11), (3, "en", "s2", 11), (None, "de", None, 5), (900, "xx", "s1", 50), (901, "de", "s9", None)]


@pytest.mark.parametrize("budget", [0.3, 1.0, 2.5, 40.0])
def test_matches_brute_force(spark, budget):
    weights = {"en": 0.5, "de": 0.4}
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    levels = [Level("lang", weights, 0.0), Level("source")]
    got = mixing.copies(docs, levels, budget=budget, max_epochs=3, seed=7).collect()
    assert {(r.lang, r.source, r.doc_id): r.copies for r in got} == brute(ROWS, weights, budget, 3, 7)
    assert len(got) == len({(r.lang, r.source, r.doc_id) for r in got})


def test_shortages_go_to_siblings_first(spark):
    rows = [("a", "x", 10), ("a", "y", 1000), ("b", "x", 1000)]
    leaves = spark.createDataFrame(rows, "lang string, source string, supply long")
    levels = [Level("lang", {"a": 0.5, "b": 0.5}), Level("source", {}, 1.0)]
    target = {(r.lang, r.source): r.target for r in mixing.budgets(leaves, levels, 400, 1).collect()}
    assert target == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 200}
    target = {(r.lang, r.source): r.target for r in mixing.budgets(leaves, levels, 2008, 1).collect()}
    assert target == {("a", "x"): 10, ("a", "y"): 998, ("b", "x"): 1000}


def test_leaves_without_weight_are_no_capacity(spark):
    rows = [("a", "en", 100), ("a", "xx", 900), ("b", "en", 1000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, supply long")
    levels = [Level("domain", {"a": 0.5, "b": 0.5}), Level("lang", {"en": 1.0})]
    target = {(r.domain, r.lang): r.target for r in mixing.budgets(leaves, levels, 2000, 4).collect()}
    assert target == {("a", "en"): 400, ("b", "en"): 1600}
    levels = [Level("domain", {"a": 0.5, "b": 0.5}), Level("lang", {"yy": 1.0})]
    assert mixing.budgets(leaves, levels, 2000, 4).collect() == []


def test_rows_are_repeated_with_all_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("clash") for c in ("copies", "__key", "key", "Copy")})
    levels = [Level("lang", {"en": 1.0, "de": 1.0}), Level("source")]
    want = {(r.lang, r.source, r.doc_id): r.copies for r in mixing.copies(docs, levels, budget=1.2).collect()}
    mixed = mixing.mix(docs, levels, budget=1.2)
    assert mixed.columns == docs.columns
    got = Counter(tuple(r)[:4] for r in mixed.collect())
    assert got == Counter({r: ROWS.count(r) * want[r[1], r[2], r[0]] for r in set(ROWS) if want[r[1], r[2], r[0]]})


def test_no_rows_and_estimates(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.copies(empty, [Level("lang"), Level("source")]).collect() == []
    assert mixing.mix(empty, [Level("lang"), Level("source")]).collect() == []
    rows = [("src5", "a b\n\tc"), ("x", None), ("src8", ""), (None, "  a " * 300_000), ("src99999999999", "a b")]
    got = spark.createDataFrame(rows, "source string, text string").select(mixing.number_domain(), mixing.word_tokens())
    assert [tuple(r) for r in got.collect()][:4] == [("books", 3), ("other", 0), ("web", 0), ("other", 300_000)]
