import math
import random
from itertools import product

import numpy as np
import pytest

from latticework.llm import quality, toxicity

SCHEMA = "doc_id long, text string"
BAD = ["moron", "idiot", "trash", "worthless"]


def corpus(n=1200, seed=6):
    rng, docs, labels = random.Random(seed), [], []
    syllables = ["the", "an", "re", "on", "st", "in", "er", "ti", "ha", "ou", "le", "sh"]
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 80))]
        toxic = rng.random() < 0.2
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, truth = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs, dict(truth), toxicity.train(docs, spark.createDataFrame(truth, "doc_id long, toxic int"))


def test_held_out_accuracy(fitted):
    docs, truth, scorer = fitted
    held = toxicity.score(docs, scorer).where(quality.held_out()).collect()
    assert len(held) > 200
    assert sum((r.score >= 0.3) == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_disguised_words_are_restored_and_scored(fitted, spark):
    _, _, scorer = fitted
    plain = "hathe anre onst {} tileou reshin the {} erstha inre"
    rows = [
        (0, plain.format("leou", "shti")),
        (1, plain.format("1d10t", "m0r0n")),
        (2, plain.format("M O R O N", "i.d.i.o.t!")),
        (3, plain.format("tra$h", "idiooooot")),
        (4, plain.format("w0rthle$s", "tr@sh***")),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    scores = [r.score for r in toxicity.score(docs, scorer).orderBy("doc_id").collect()]
    assert scores[0] < 0.3 and min(scores[1:]) >= 0.3
    texts = [r.text for r in toxicity.restore(docs, scorer.restorer).orderBy("doc_id").collect()]
    assert texts[0] == rows[0][1]
    for text, words in zip(texts[1:], (["idiot", "moron"], ["moron", "idiot"], ["trash", "idiot"], ["worthless"])):
        assert all(word in text for word in words)


FORMS = [
    "mo.ron", "m.oron", "mo-ron", "st_upid", "mo..ron", "m,o,r,o,n", "m'o'r'o'n", "morron", "stuupid", "mo ron",
    "st up id", "(lown", "(m o r o n)", '"m o r o n"', "m0 ron", "mor-r0n",
]


@pytest.fixture(scope="module")
def insults(spark):
    rows, truth = corpus()
    rng = random.Random(9)
    more = [(i, t if not toxic else f"{t} {rng.choice(['clown', 'stupid'])}") for (i, t), (_, toxic) in zip(rows, truth)]
    return toxicity.train(spark.createDataFrame(more, SCHEMA), spark.createDataFrame(truth, "doc_id long, toxic int"))


@pytest.mark.parametrize("form", FORMS)
def test_each_form_of_disguise_is_evidence(insults, form):
    plain = "hathe anre onst {} tileou reshin the shti erstha inre"
    word = "clown" if "lown" in form else "stupid" if "st" in form else "moron"
    assert insults.evidence(plain.format(form)) == insults.evidence(plain.format(word))


def test_ordinary_words_side_by_side_are_not_joined(insults):
    hidden = toxicity.Hidden({"onst": 3.0, "moron": 3.0}, frozenset({"on", "st"}))
    assert hidden.joined("the on st re".split()) == set()
    assert hidden.joined("the on sst re".split()) == {"onst"}
    assert hidden.whole("on-st") == set() and hidden.whole("mo-ron") == {"moron"}
    assert insults.evidence("hathe anre onst, tileou (the) on the 455 re-on st's")[1] == 0


def all_readings(restorer, seen):
    """The best reading by trying every choice for every sign."""
    best = (-math.inf, "")
    for choice in product(*(restorer._options(seen, at) for at in range(len(seen)))):
        a = b = 0
        value, read = 0.0, ""
        for code, cost in choice:
            value -= cost
            if code == 0:
                value += restorer.log[(a * toxicity.N + b) * toxicity.N] if b else 0.0
                read += " " if b else ""
                a = b = 0
            elif code > 0:
                value += restorer.log[(a * toxicity.N + b) * toxicity.N + code]
                read += toxicity.LETTERS[code - 1]
                a, b = b, code
        value += restorer.log[(a * toxicity.N + b) * toxicity.N]
        best = max(best, (value, read))
    return best[1].strip()


def test_viterbi_finds_the_best_reading(fitted):
    restorer = fitted[2].restorer
    rng = random.Random(1)
    for _ in range(60):
        seen = "".join(rng.choice("moronidt10$@ .-é#") for _ in range(rng.randrange(1, 8)))
        assert restorer._decode(seen) == all_readings(restorer, seen)


def test_grams_count_every_word(spark):
    rows = [(1, "Ab ab\nabc"), (2, None), (3, "ÉB 7ab")]
    found = {r.gram: r.times for r in toxicity.gram_counts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}

    def gram(text):
        a, b, c = (toxicity._INDEX.get(x, 0) for x in text)
        return (a * toxicity.N + b) * toxicity.N + c

    assert found[gram("  a")] == 4 and found[gram(" ab")] == 4 and found[gram("ab ")] == 3
    assert found[gram("abc")] == 1 and found[gram(" éb")] == 1


def test_without_copies_keeps_one(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(50)) for _ in range(200))
    other = " ".join(rng.choice("ijklmnop") * 3 + str(rng.randrange(50)) for _ in range(200))
    rows = [(1, 0, text), (2, 0, text + " end"), (3, 1, other), (4, 1, None), (5, 1, "")]
    kept = toxicity.without_copies(spark.createDataFrame(rows, "id long, label int, text string")).collect()
    assert sorted(r.id for r in kept) == [1, 3, 4]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 2), (None, "", 2), (1, None, 2), (3, "x" * 300_000, 2)], SCHEMA + ", score int")
    for labels in ([], [(1, 1)], [(1, 1), (3, 0)], [(3, None)]):
        scorer = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = toxicity.score(docs, scorer)
        assert got.columns == ["doc_id", "text", "score"]
        assert got.count() == 4 and all(0 <= r.score <= 1 for r in got.collect())
    assert toxicity.score(docs.limit(0), scorer).collect() == []
    assert np.isfinite(scorer.model).all()
