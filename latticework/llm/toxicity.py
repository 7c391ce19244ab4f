"""Toxicity: disguised words are restored by a noisy channel, then the restored text is scored."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticework.llm.quality import SAMPLE, training_rows
from latticework.llm.text import Remembered, Windows, as_bytes, hasher, smaller_batches, word_hashes
from latticework.operators.joins import fresh
from latticework.session import materialize

# Letters of the language model; 0 stands for the border of a word.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâäåæçèéêëíîïñóôöøùúûüœ"
# What a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "а": "a", "е": "e", "і": "i", "о": "o",
    "р": "p", "с": "c", "у": "y", "х": "x",
}
SEPARATORS = " \t\n.,-_*~'/:;"
# Costs, as negative logarithms of the channel: a sign for a letter; the base of an accented letter; a
# separator that ends a word rather than nothing; a sign, and a sign that may be a letter, for nothing or the
# end of a word; a dropped second letter; a dropped letter of a longer run.
SIGN, ACCENT, BORDER, NOISE, NO_LETTER, SECOND, RUN = 1.5, 3.0, 3.0, 4.0, 12.0, 6.0, 0.5

N = len(LETTERS) + 1
_INDEX = {letter: i + 1 for i, letter in enumerate(LETTERS)}
_CODES = np.zeros(0x180, np.int64)
for _letter, _i in _INDEX.items():
    _CODES[ord(_letter)] = _i
_BASES = {c: base for c in LETTERS if (base := unicodedata.normalize("NFKD", c)[0]) != c and base in _INDEX}

_LETTER = r"[^\W\d_]"
_SIGNS = "".join(map(re.escape, LEET))
# A word with letters is decoded if it also has a separator, a sign or a letter twice in a row.
_LETTERED = re.compile(_LETTER)
_ODD = re.compile(rf"[\W\d_{_SIGNS}]|(.)\1")
# Three or more single letters or signs with gaps between them; brackets and quotes may stand around them.
_ONE = rf"[^\W_]|[@$!|+€£]"
SPACED = re.compile(
    rf"(?<![^\s(\[{{<\"'“‘«])(?:{_ONE})(?:[\s.\-_*~/:]+(?:{_ONE})){{2,}}(?![^\s.,;:!?)\]}}>\"'”’»])"
)
# Such a letter or sign inside a word; ``SPACED`` takes none else.
_ALONE = re.compile(rf"(?<![^\s(\[{{<\"'“‘«.\-_*~/:])(?:{_ONE})(?![^\s.,;:!?)\]}}>\"'”’»\-_*~/])")
# Marks at the edges of a word that stand for no letter, and a letter said twice or more.
_MARKS, _RUN = ".,;:?\"')", re.compile(r"(.)\1+")
_LETTERS_ONLY, _BARE = re.compile(f"[{LETTERS}]+"), str.maketrans(_BASES)
# Punctuation around a word; one or two signs of money may be letters.
_EDGES = re.compile(r"^(?:[^\w@$€£]|[@$€£]{2,})+|(?:[^\w$]|\${3,})+$")
# The same without the signs at an edge that may be letters.
_OUTER = re.compile(rf"^[^\w{_SIGNS}]+|[^\w{_SIGNS}]+$")

# A lexicon word may hide in a text at this channel cost for each of its letters at most.
HIDING = 3.0
# Words in a thousandth of the clean rows, and in three at least, are ordinary; so many of them at most.
ORDINARY, ORDINARY_SHARE = 20_000, 1e-3

# Labelled rows, and features, that the scorer is fitted on at most.
LEXICON = 4_000
# Distinct words that a task knows what they stand for.
WORDS = 200_000
PREFIXES = (3, 4, 5, 6, 7, 8)
# A feature is toxic if the likelihood ratio of its counts and its log-odds are this high at least.
RATIO, ODDS = 24.0, 2.5


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(N**3, np.int64)
    for batch in smaller_batches(batches, "text", 4 << 20):
        joined = "  ".join(t for t in batch.column("text").to_pylist() if t).lower()
        points = np.frombuffer(f"  {joined}  ".encode("utf-32-le", "replace"), "<u4")
        codes = np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], 0)
        # A run of borders is one.
        codes = codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]
        codes = np.insert(codes, np.flatnonzero(codes == 0), 0)
        total += np.bincount((codes[:-2] * N + codes[1:-1]) * N + codes[2:], minlength=N**3)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["gram", "times"])


def gram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, times): how often three characters follow each other, over all words of all documents.

    A gram is a number below ``N**3``, so each task sends that many rows at most, and so has the result.
    """
    found = docs.select(F.col(text).alias("text")).mapInArrow(_grams, "gram int, times long")
    return found.groupBy("gram").agg(F.sum("times").alias("times"))


def disguised(core: str) -> bool:
    """Whether a word without signs at its edges is decoded."""
    return _ODD.search(core) is not None and _LETTERED.search(core) is not None


def options(seen: str, at: int) -> list[tuple[int, float]]:
    """What the sign at ``at`` may stand for, with its cost; -1 is nothing, 0 the border of a word."""
    sign, found = seen[at], []
    if sign in _INDEX:
        found.append((_INDEX[sign], 0.0))
        if sign in _BASES:
            found.append((_INDEX[_BASES[sign]], ACCENT))
    found += [(_INDEX[letter], SIGN) for letter in LEET.get(sign, "")]
    if sign in SEPARATORS:
        found += [(0, BORDER), (-1, 0.0)]
    elif at and seen[at - 1] == sign:
        longer = seen[at - 2 : at - 1] == sign or seen[at + 1 : at + 2] == sign
        found.append((-1, RUN if longer else SECOND))
    elif sign not in _INDEX:
        cost = NO_LETTER if sign in LEET else NOISE
        found += [(0, cost), (-1, cost)]
    return found


class Restorer:
    """Viterbi decoder of disguised words under a character model of three letters."""

    def __init__(self, times: np.ndarray):
        cube = times.reshape(N, N, N).astype(np.float64)
        two, one = cube.sum(axis=0), cube.sum(axis=(0, 1))
        one = (one + 1) / (one.sum() + N)
        two = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
        three = (cube + 5 * two[None]) / (cube.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(three).ravel().tolist()
        self.known = Remembered(self._decode)

    @classmethod
    def of(cls, counts: DataFrame) -> Restorer:
        rows, times = counts.toArrow(), np.zeros(N**3, np.int64)
        times[np.asarray(rows.column("gram"))] = np.asarray(rows.column("times"))
        return cls(times)

    def __getstate__(self):
        return {"log": np.array(self.log, np.float32)}

    def __setstate__(self, state):
        self.log, self.known = state["log"].tolist(), Remembered(self._decode)

    def _options(self, seen: str, at: int) -> list[tuple[int, float]]:
        return options(seen, at)

    def _decode(self, seen: str) -> str:
        # The best way to each pair of last letters: its value and what it reads.
        ways = {(0, 0): (0.0, "")}
        for at in range(len(seen)):
            following: dict[tuple[int, int], tuple[float, str]] = {}
            for code, cost in self._options(seen, at):
                for (a, b), (value, read) in ways.items():
                    if code == -1:
                        key, value, now = (a, b), value - cost, read
                    elif code == 0:
                        # A border after a border says nothing.
                        gain = self.log[(a * N + b) * N] if b else 0.0
                        key, value, now = (0, 0), value + gain - cost, f"{read} " if b else read
                    else:
                        key = (b, code)
                        value, now = value + self.log[(a * N + b) * N + code] - cost, read + LETTERS[code - 1]
                    if key not in following or value > following[key][0]:
                        following[key] = (value, now)
            ways = following
        return max((value + self.log[(a * N + b) * N], read) for (a, b), (value, read) in ways.items())[1].strip()

    def word(self, word: str) -> str:
        """A word between white space, in lower case and without signs at its edges; restored if disguised."""
        core = _EDGES.sub("", word)
        return self.known[core] if disguised(core) else core

    def text(self, text: str | None) -> str:
        """The whole text in lower case, its disguised words and spaced-out letters restored."""
        spaced = SPACED.sub(lambda m: self.known[" ".join(m[0].split())], (text or "").lower())
        return re.sub(r"\S+", lambda m: self.known[c] if disguised(c := _EDGES.sub("", m[0])) else m[0], spaced)

    def spaced(self, text: str) -> set[str]:
        """The words that spaced-out letters of a lower-case text read."""
        return {word for m in SPACED.finditer(text) for word in self.known[" ".join(m[0].split())].split()}

    def words(self, text: str | None) -> set[str]:
        """The distinct words of the restored text."""
        text = (text or "").lower()
        return self.spaced(text).union(*(self.word(word).split() for word in set(text.split())))


def _three_alone(some: list[tuple[int, Seen]]) -> bool:
    """Whether neighbouring words have three signs that stand alone, and no other words between them."""
    last, total = -1, 0
    for at, seen in some:
        if seen.alone:
            last, total = at, (total if at == last + 1 else 0) + seen.alone
            if total > 2:
                return True
    return False


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked with a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


class Hidden:
    """Finds the words of a lexicon that the channel may have turned into what is seen, whole or in pieces."""

    def __init__(self, weights: dict[str, float], ordinary: frozenset[str]):
        self.words = {f for f in weights if not f.endswith("*")}
        self.begins = {word[:n] for word in self.words for n in range(len(word) + 1)}
        self.ordinary = ordinary
        # Without accents: beginnings of words; with runs of a letter as one letter: words and other features.
        self.bare_begins = {word.translate(_BARE) for word in self.begins}
        self.single = {_single(word) for word in self.words}
        self.single_begins = {_single(f[:-1]) for f in weights if f.endswith("*")}
        self.starts = Remembered(self._start, WORDS)

    def walk(self, ways: dict[str, float], seen: str) -> dict[str, float]:
        """The beginnings of lexicon words that ``ways`` and then ``seen`` read, with what they cost."""
        for at in range(len(seen)):
            following: dict[str, float] = {}
            for code, cost in options(seen, at):
                if code == 0:
                    continue
                letter = LETTERS[code - 1] if code > 0 else ""
                for read, value in ways.items():
                    now, total = read + letter, value + cost
                    if now in self.begins and total < following.get(now, np.inf):
                        following[now] = total
            if not following:
                return following
            ways = following
        return ways

    def read(self, ways: dict[str, float]) -> set[str]:
        return {word for word, cost in ways.items() if word in self.words and cost <= HIDING * len(word)}

    def whole(self, word: str) -> set[str]:
        """Lexicon words that a disguised word between white space may stand for; ordinary words stand for themselves."""
        found: set[str] = set()
        for core in {_EDGES.sub("", word), _OUTER.sub("", word)}:
            if disguised(core) and not self.ordinary.issuperset(re.findall(r"\w+", core)):
                found |= self.read(self.walk({"": 0.0}, core))
        return found

    def reachable(self, core: str) -> bool:
        """Whether a word of letters may read a feature if letters are said twice or lose their accents: neither
        changes what is left without accents and with runs of a letter as one letter."""
        single = _single(core)
        return single in self.single or any(single[:n] in self.single_begins for n in range(1, PREFIXES[-1] + 1))

    def _start(self, word: str) -> tuple[str, bool, dict[str, float]]:
        """A word's core, whether it is ordinary, and the beginnings of lexicon words that it reads."""
        core = bare_core(word)
        if core is not None and not _RUN.search(core):
            # Only accents can be lost.
            some = core.translate(_BARE) in self.bare_begins
            return core, core in self.ordinary, self.walk({"": 0.0}, core) if some else {}
        core = _EDGES.sub("", word)
        return core, core in self.ordinary, self.walk({"": 0.0}, core) if core else {}

    def joined(self, words: list[str], begin: Iterable[int] | None = None) -> set[str]:
        """Lexicon words that are split in pieces by white space, from the words number ``begin`` on, all by
        default; one piece at least is no ordinary word."""
        found: set[str] = set()
        for i in range(len(words)) if begin is None else begin:
            (_, plain, ways), at = self.starts[words[i]], i + 1
            while ways and at < len(words):
                core, ordinary, _ = self.starts[words[at]]
                if not core:
                    break
                plain, ways, at = plain and ordinary, self.walk(ways, core), at + 1
                if not plain:
                    found |= self.read(ways)
        return found


def _single(word: str) -> str:
    return _RUN.sub(r"\1", word.translate(_BARE))


def bare_core(word: str) -> str | None:
    """The letters of a word that has only letters between marks that stand for none; None for other words."""
    core = word if word.isalpha() else word.strip(_MARKS)
    return core if _LETTERS_ONLY.fullmatch(core) else None


class Seen(NamedTuple):
    """What a word between white space may say: whether lexicon words may begin with it, how many signs stand alone
    in it, and the toxic words it stands for, with their weights."""

    begins: bool
    alone: int
    found: tuple[tuple[str, float], ...]


@dataclass
class Scorer:
    """A lexicon of toxic features and a logistic model of how many a text has."""

    restorer: Restorer
    weights: dict[str, float]
    model: np.ndarray
    ordinary: frozenset[str] = frozenset()
    known: Remembered = field(init=False)
    hidden: Hidden = field(init=False)
    heads: set[str] = field(init=False)

    def __post_init__(self):
        self.known, self.hidden = Remembered(self._see, WORDS), Hidden(self.weights, self.ordinary)
        self.heads = {f[: PREFIXES[0]] for f in self.weights if f.endswith("*")}

    def __getstate__(self):
        return self.restorer, self.weights, self.model, self.ordinary

    def __setstate__(self, state):
        self.restorer, self.weights, self.model, self.ordinary = state
        self.__post_init__()

    def _weigh(self, words: list[str] | set[str]) -> tuple[tuple[str, float], ...]:
        some = (word for word in words if word in self.weights or word[: PREFIXES[0]] in self.heads)
        best = ((word, max(self.weights.get(f, 0.0) for f in features_of(word))) for word in some)
        return tuple(pair for pair in best if pair[1] > 0)

    def _see(self, word: str) -> Seen | None:
        core = bare_core(word)
        if core is None:
            found = self._weigh(self.restorer.word(word).split()) or self._weigh(self.hidden.whole(word))
            alone = len(_ALONE.findall(word))
        elif word != core:
            # Marks say nothing.
            return self.known[core]
        else:
            found, alone = (), len(core) == 1
            if not disguised(core):
                found = self._weigh((core,))
            elif self.hidden.reachable(core):
                found = self._weigh(self.restorer.known[core].split()) or self._weigh(self.hidden.whole(core))
        seen = Seen(bool(self.hidden.starts[word][2]), alone, found)
        return seen if any(seen) else None

    def evidence(self, text: str | None) -> list[float]:
        """One, and how many distinct toxic words there are, what they weigh together, and the heaviest."""
        text = (text or "").lower()
        words = text.split()
        some = [(at, seen) for at, seen in enumerate(map(self.known.__getitem__, words)) if seen]
        found = dict(chain.from_iterable({seen.found for _, seen in some if seen.found}))
        if _three_alone(some):
            found.update(self._weigh(self.restorer.spaced(text)))
        found.update(self._weigh(self.hidden.joined(words, [at for at, seen in some if seen.begins])))
        weights = found.values()
        return [1.0, float(np.log1p(len(weights))), float(np.log1p(sum(weights))), max(weights, default=0.0)]

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.evidence(t) for t in texts]).reshape(-1, 4)
        return 1 / (1 + np.exp(-(x @ self.model)))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.5) -> np.ndarray:
    """Weights of a penalised logistic model, by Newton's method; the first column is one."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [penalty] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-(x @ w)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return w


def _feature_counts(restorer: Restorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {0: Counter(), 1: Counter()}
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                totals[label].update({f for word in restorer.words(text) for f in features_of(word)})
                totals[label][""] += 1
        for label, counter in totals.items():
            columns = [pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())]
            zero = pa.array([0] * len(counter), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [columns[0], *([zero, columns[1]] if label else [columns[1], zero])], ["feature", "clean", "toxic"]
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Eight pairs of least hashes of the text's word quadruples; copies share some, other texts rarely."""
    known, windows = hasher(), Windows(0xA0761D6478BD642F)
    steps = (np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for batch in smaller_batches(batches, "text", 1 << 20):
        found = []
        for data in as_bytes(batch.column("text")):
            hashes = word_hashes((data or b"").lower(), known)
            shingles = windows.of(hashes, min(4, max(1, len(hashes))))
            least = [int((shingles * step).min()) if len(shingles) else 0 for step in steps]
            found.append([hash((i, *least[i : i + 2])) for i in range(0, 16, 2)])
        ids = batch.column("id")
        yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.list_(pa.int64()))], ["id", "bands"])


def without_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (id, label, text) without near copies of others, so that one text counts once.

    ``rows`` are the bounded sample: the driver gets eight numbers for each and sends back ids.
    """
    found = rows.mapInArrow(_bands, "id long, bands array<long>").collect()
    seen, kept = set(), []
    for row in sorted(found, key=lambda r: r["id"]):
        if seen.isdisjoint(row["bands"]):
            kept.append((row["id"],))
        seen.update(row["bands"])
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(kept, "id long")), "id")


def _evidence(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [scorer.evidence(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x)], ["label", "x"])

    return run


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text",
    sample: int = SAMPLE, lexicon: int = LEXICON,
) -> Scorer:
    """A scorer for ``docs``.

    The character model counts every word of every document. The lexicon comes from four fifths of at most
    ``sample`` labelled documents, none held out and without near copies: features that are far more frequent in toxic ones, by
    a likelihood ratio, at most ``lexicon`` of them; their most common clean words are ordinary. The rest fits how much evidence makes a text
    toxic. Tasks count; the driver gets the grams, the lexicon, the ordinary words and the numbers of the fit, all bounded.
    """
    restorer = Restorer.of(gram_counts(docs, text))
    rows = materialize(training_rows(docs, labels, label, id, text, sample), "toxicity-sample")
    rows = without_copies(rows)
    fifth = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    counts = rows.where(~fifth).mapInArrow(_feature_counts(restorer), "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = rows.where(~fifth).agg(
        F.count("*").alias("all"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")
    ).first()
    n_toxic, n_clean = total["toxic"], total["all"] - total["toxic"]
    if not n_toxic or not n_clean:
        share = (n_toxic + 1) / (n_toxic + n_clean + 2)
        return Scorer(restorer, {}, np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0]))
    base = n_toxic / (n_toxic + n_clean)
    t, c = F.col("toxic"), F.col("clean")
    odds = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    share = t / (t + c)
    ratio = 2 * (
        t * F.log(share / base) + F.when(c > 0, c * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    )
    counts = materialize(counts, "toxicity-counts")
    chosen = (
        counts.where((F.col("feature") != "") & (t > 2))
        .select("feature", odds.alias("odds"), ratio.alias("ratio"))
        .where((F.col("odds") >= ODDS) & (F.col("ratio") >= RATIO))
        .orderBy(F.desc("ratio"), "feature")
        .limit(lexicon)
        .collect()
    )
    weights = {r["feature"]: r["odds"] for r in chosen}
    plain = counts.where((F.col("feature") != "") & ~F.col("feature").endswith("*"))
    common = plain.where(c >= max(3.0, ORDINARY_SHARE * n_clean)).orderBy(c.desc(), "feature").limit(ORDINARY)
    ordinary = frozenset(r["feature"] for r in common.select("feature").collect()) - weights.keys()
    scorer = Scorer(restorer, weights, np.zeros(4), ordinary)
    fitted = rows.where(fifth).mapInArrow(_evidence(scorer), "label int, x array<double>").collect()
    x = np.array(sorted((*r["x"], r["label"]) for r in fitted)).reshape(-1, 5)
    scorer.model = _logistic(x[:, :4], x[:, 4]) if len(np.unique(x[:, 4])) > 1 else np.array([-4.0, 2.0, 2.0, 0.0])
    return scorer


def _scores(scorer: Scorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, -1):
            found = scorer.score(batch.column(-1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], [*batch.schema.names[:-1], "score"])

    return run


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """``docs`` with the column score, 0 to 1, higher where a toxic label is likelier.

    Whole texts are read; null and empty texts have no evidence. All columns stay, whatever their names, but one named
    score, in any case, is replaced. Repeated rows and null ids stay. No rows: no rows.
    """
    rows = docs.drop("score")
    kept = rows.select("*", docs[text].alias(fresh("text", rows.columns)))
    return kept.mapInArrow(_scores(scorer), rows.schema.add("score", "double"))


def restore(docs: DataFrame, restorer: Restorer, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` in lower case and its disguised words restored; null becomes empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, text):
            at = batch.schema.names.index(text)
            texts = pa.array([restorer.text(t) for t in batch.column(at).to_pylist()], pa.string())
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
