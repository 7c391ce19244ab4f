import random
import re
from collections import Counter

import pytest

from latticework.llm import host_rules

SCHEMA = "doc_id long, text string, source string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered)


def rows():
    rng, out = random.Random(8), []
    for i in range(120):
        words = [rng.choice(["a", "bé", "c#", "<d>", "ß", "e f", "\x1c", "x y"]) for _ in range(rng.randrange(60))]
        if rng.random() < 0.3:
            words += words[-8:] * 2
        out.append((i, "".join(w + rng.choice([" ", " ", "\n", "\t\r\n", "\n\n"]) for w in words), f"s{i % 5}"))
    return out + [(200, None, "s1"), (201, "", None), (None, "a b", None), (3, "twice", "s0"), (3, "twice", "s0")]


def test_counts_match_brute_force(spark):
    data = rows()
    got = host_rules.counts(spark.createDataFrame(data, SCHEMA)).collect()
    want = Counter((i, s, *brute(t)) for i, t, s in data)
    assert Counter(map(tuple, got)) == want


def test_rates_are_shrunk_towards_all_hosts(spark):
    judged = [("big", k < 10) for k in range(100)] + [("tiny", True)] + [("bad", k < 95) for k in range(100)]
    judged += [(f"h{h}", k < 10) for h in range(8) for k in range(100)]
    found = host_rules.host_verdicts(spark.createDataFrame(judged, "host string, rule boolean"), ["rule"]).collect()
    by_host = {r.host: r for r in found}
    n = len(judged)
    mean = sum(f for _, f in judged) / n
    fails, size = Counter(h for h, f in judged if f), Counter(h for h, _ in judged)
    variance = sum(size[h] * (fails[h] / size[h] - mean) ** 2 for h in size) / n - mean * (1 - mean) * (len(size) - 1) / n
    weight = max(mean * (1 - mean) / variance - 1, 1.0)
    for h, r in by_host.items():
        assert r.rate_rule == pytest.approx((fails[h] + weight * mean) / (size[h] + weight))
        rate = r.rate_rule
        assert r.least_rule == pytest.approx(rate - 2 * (rate * (1 - rate) / (size[h] + weight + 1)) ** 0.5)
        assert r.host_ok == (not (rate > 0.5 or rate >= 0.1 and r.least_rule > 3 * mean))
    assert mean < by_host["tiny"].rate_rule < 1
    assert not by_host["bad"].host_ok and by_host["big"].host_ok


def test_hosts_are_judged_against_each_other(spark):
    judged = [(f"h{h}", k < 2) for h in range(30) for k in range(100)] + [("far", k < 30) for k in range(100)]
    judged += [("small", True), ("small", False)]
    found = host_rules.host_verdicts(spark.createDataFrame(judged, "host string, rule boolean"), ["rule"]).collect()
    # Half of the documents of two are no evidence; three tenths of a hundred are, where others have a fiftieth.
    assert [r.host for r in found if not r.host_ok] == ["far"]
    alike = [(f"h{h}", k < 30) for h in range(30) for k in range(100)]
    found = host_rules.host_verdicts(spark.createDataFrame(alike, "host string, rule boolean"), ["rule"]).collect()
    assert all(r.host_ok for r in found)


def test_documents_of_a_bad_host_go(spark):
    good = " ".join(f"w{i}" for i in range(30))
    data = [(i, good, "good") for i in range(50)] + [(100 + i, "x", "bad") for i in range(50)] + [(200, good, "bad")]
    got = {r.id: (r.base_failed, r.kept) for r in host_rules.judge(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got[0] == (False, True) and got[100] == (True, False) and got[200] == (False, False)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, None, 7), (None, "a", "", 8), (1, None, None, 7)], SCHEMA + ", kept int")
    got = host_rules.judge(docs)
    assert got.count() == 3 and "host_key" not in got.columns
    assert host_rules.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    one = host_rules.judge(spark.createDataFrame([(1, "w " * 500_000, "s")], SCHEMA)).first()
    assert (one.n_words, one.n_repeat_words, one.kept) == (500_000, 500_000, False)
