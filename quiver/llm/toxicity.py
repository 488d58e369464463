"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms and accents, look-alike letters of
other scripts, digits and signs that stand for letters inside a word, invisible characters.
The lexicon holds whole words and stems (beginnings of words). It is learned from labelled
documents: terms are counted per label, the ones that tell most are taken one after another
until every toxic document is covered a few times, and each gets the log of its odds as its
weight. Phrases around a term that occur in clean documents only are exceptions: a match
inside one does not count. A document's score is a logistic function of the weight of its
matches divided by its length in words, fitted on the same labelled rows.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import column, id_text, pin, text_steps

# ---------------------------------------------------------------- folding

#: Letters of other scripts that look like Latin ones (fixed values).
_ALIKE = str.maketrans("аеорсухіјѕԁһкмтвнαοειυνρτκıøłđßæ", "aeopcyxijsdhkmtbhaoeiuvptkioldsa")
#: Digits and signs written for letters (fixed values); l, i, 1, | and ! are one class.
_STANDS = str.maketrans("0134578@$|!l", "oieastbasiii")
_ONE_CLASS = str.maketrans("l", "i")
_HIDDEN = re.compile("[\u00ad\u034f\u200b-\u200f\u2060-\u2064\ufeff]+|[\u0300-\u036f]+")  # invisible, combining
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]*+[0-9@$|!](?:[0-9@$|!]|[^\W\d_])*")
_WORD = re.compile(r"[^\W\d_]+")


def _substituted(match: re.Match) -> str:
    """A run of letters, digits and signs with the signs read as letters, if it holds a letter;
    signs at its end are punctuation."""
    run = match.group()
    body = run.rstrip("@$|!")
    return body.translate(_STANDS) + run[len(body):] if any(c.isalpha() for c in body) else run


def fold(text: str) -> str:
    """The text as the lexicon sees it."""
    if text.isascii():
        text = text.lower()
    else:
        text = _HIDDEN.sub("", unicodedata.normalize("NFKD", text.casefold())).translate(_ALIKE)
    return _MIXED.sub(_substituted, text).translate(_ONE_CLASS)


def words_of(text: str) -> list[str]:
    """Folded words: runs of letters."""
    return _WORD.findall(fold(text))


#: Stems are the first 4 to 8 letters of a word.
STEMS = range(4, 9)


def terms_of(words: set[str]) -> set[str]:
    """The terms that words of a text are evidence for: ``word `` whole, ``stem`` a beginning."""
    out = {w + " " for w in words}
    for w in words:
        out.update(w[:k] for k in STEMS if k <= len(w))
    return out


# ---------------------------------------------------------------- the matcher

class Matcher:
    """The automaton over terms and exception phrases. Texts are matched as folded words with
    one space before, between and after, so a term is found at the beginning of words only."""

    def __init__(self, terms: list[str], exceptions: list[str] = ()):
        self.terms, self.exceptions = list(terms), list(exceptions)
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for k, term in enumerate(self.terms):
                self._automaton.add_word(" " + term, (k, len(term) + 1))
            for phrase in self.exceptions:
                self._automaton.add_word(f" {phrase} ", (-1, len(phrase) + 2))
            if self.terms:
                self._automaton.make_automaton()
        return self._automaton

    def matches(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(term, start, end) of the matches that count: of the terms that begin at one word the
        longest, unless the word lies inside an exception phrase. A word said again and again
        without another between counts once."""
        if not self.terms or not words:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        excused: list[tuple[int, int]] = []
        for end, (k, size) in self.automaton().iter(f" {' '.join(_once(words))} "):
            start = end - size + 1
            if k < 0:
                excused.append((start, end))
            elif start not in best or end > best[start][2]:
                best[start] = (k, start, end)
        if excused:
            return [m for m in best.values() if not any(a <= m[1] and m[2] <= b for a, b in excused)]
        return list(best.values())

    def counts(self, words: list[str]) -> dict[int, int]:
        out: dict[int, int] = {}
        for k, _, _ in self.matches(words):
            out[k] = out.get(k, 0) + 1
        return out

    def phrases(self, words: list[str]) -> set[str]:
        """The two-word phrases around the matches, those that may become exceptions."""
        joined = f" {' '.join(_once(words))} "
        out = set()
        for _, start, _ in self.matches(words):
            end = joined.index(" ", start + 1)
            if start:
                out.add(joined[joined.rindex(" ", 0, start) + 1: end])
            if end < len(joined) - 1:
                out.add(joined[start + 1: joined.index(" ", end + 1)])
        return out


def _once(words: list[str]) -> list[str]:
    return [w for w, before in zip(words, [None, *words]) if w != before]


class Scorer:
    """A fitted lexicon: weights of the matcher's terms and the logistic curve over density."""

    def __init__(self, matcher: Matcher, weights: np.ndarray, slope: float, offset: float, spare: float):
        self.matcher, self.weights, self.slope, self.offset, self.spare = matcher, weights, slope, offset, spare

    def density(self, found: dict[int, int], n_words: int) -> float:
        """Weight of the matches per hundred words; ``spare`` words more, so that one match in a
        very short text is not everything."""
        return 100 * sum(self.weights[k] * n for k, n in found.items()) / (n_words + self.spare)

    def score(self, density: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(density) + self.offset, -500, 500)))


# ---------------------------------------------------------------- learning

def cover(rows: np.ndarray, terms: np.ndarray, toxic: np.ndarray, names: list[str], depth: int = 3, least: int = 4,
          odds: float = 8.0, size: int = 500) -> list[int]:
    """Terms taken one after another: the one with the largest log-likelihood gain over the
    documents not yet covered ``depth`` times by terms taken before; of equal ones the longest.
    (rows, terms) are the (document, term) pairs, ``toxic`` the documents' labels. A term needs
    ``least`` such toxic documents, and odds that are ``odds`` times those of all documents; a
    term taken rules out its own beginnings and, if it is a stem, the words it begins."""
    all1, all0, n_terms = int(toxic.sum()), int((~toxic).sum()), len(names)
    letters = [t.rstrip() for t in names]
    clean = np.bincount(terms[~toxic[rows]], minlength=n_terms)
    own = toxic[rows]
    rows, terms = rows[own], terms[own]
    by_term = np.argsort(terms, kind="stable")
    at = np.searchsorted(terms[by_term], np.arange(n_terms + 1))
    by_row = np.argsort(rows, kind="stable")
    row_at = np.searchsorted(rows[by_row], np.arange(len(toxic) + 1))
    covered = np.zeros(len(toxic), np.int64)
    n = np.bincount(terms, minlength=n_terms).astype(np.int64)
    rate = (n + 0.5) / (all1 + 1) / ((clean + 0.5) / (all0 + 1))
    fits = (rate >= odds) & (n >= least)
    gain_of = np.log(np.maximum(rate, 1e-9)) * (1 + 1e-9 * np.array([2 * len(w) - (t != w) for t, w in zip(names, letters)]))
    taken: list[int] = []
    while len(taken) < size:
        gain = np.where(fits & (n >= least), n * gain_of, 0.0)
        k = int(np.argmax(gain))
        if gain[k] <= 0:
            break
        taken.append(k)
        stem = names[k] == letters[k]
        for j in np.flatnonzero(fits).tolist():
            if letters[k].startswith(letters[j]) or stem and letters[j].startswith(letters[k]):
                fits[j] = False
        docs = rows[by_term[at[k]: at[k + 1]]]
        covered[docs] += 1
        for d in docs[covered[docs] == depth].tolist():
            np.subtract.at(n, terms[by_row[row_at[d]: row_at[d + 1]]], 1)
    return taken


def fit_curve(density: np.ndarray, toxic: np.ndarray, steps: int = 50, penalty: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the logistic curve over log1p(density) (Newton steps)."""
    x = np.stack([np.log1p(density), np.ones(len(density))], axis=1)
    w = np.zeros(2)
    if not toxic.any() or toxic.all():
        return 0.0, (4.0 if len(toxic) and toxic.all() else -4.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - toxic) + penalty * len(x) * w * [1, 0]
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * len(x) * np.diag([1, 1e-9])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def in_fold(id_column, folds: int, held: int):
    """Whether crc32 of the id's decimal text leaves the remainder ``held``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == held


def training_rows(docs: DataFrame, labels: DataFrame, folds: int, held: int, max_labelled: int) -> DataFrame:
    """(_mark, text) of the labelled documents outside the held-out fold: of the ids with the
    smallest hashes, at most ``max_labelled``. Only marks 0 and 1 count; an id marked both
    ways is left out; of rows that repeat an id the one with the smallest text hash counts."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_mark"))
             .where(F.col("_mark").isin(0, 1) & F.col("_id").isNotNull()).where(~in_fold(F.col("_id"), folds, held))
             .groupBy("_id").agg(F.min("_mark").alias("_mark"), F.max("_mark").alias("_most"))
             .where("_mark = _most").orderBy(F.xxhash64("_id"), "_id").limit(max_labelled).select("_id", "_mark"))
    own = docs.join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))
    one = own.groupBy("_id").agg(F.first("_mark").alias("_mark"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return pin(one.select("_mark", "text"), "labelled")


def learn(docs: DataFrame, labels: DataFrame, folds: int, held: int, max_labelled: int, max_terms: int,
          exceptions: tuple[str, ...] = (), spare: float = 10.0) -> Scorer:
    """The lexicon, its exceptions and the curve, from at most ``max_labelled`` labelled rows;
    ``max_terms`` bounds the candidate terms that are looked at document by document."""
    spark = docs.sparkSession
    rows = training_rows(docs, labels, folds, held, max_labelled)

    def count_terms(batches):
        for step in text_steps(batches):
            counts: dict[str, list[int]] = {}
            for mark, text in zip(column(step, "_mark").to_pylist(), column(step, "text").to_pylist()):
                for term in terms_of(set(words_of(text))):
                    counts.setdefault(term, [0, 0])[mark] += 1
            yield pa.RecordBatch.from_pydict({"term": list(counts), "n0": [c[0] for c in counts.values()],
                                              "n1": [c[1] for c in counts.values()]})

    marks = {r._mark: r["count"] for r in rows.groupBy("_mark").count().collect()}
    all0, all1 = marks.get(0, 0), marks.get(1, 0)
    odds = (F.col("n1") + 0.5) / (all1 + 1) / ((F.col("n0") + 0.5) / (all0 + 1))
    terms = (rows.select("_mark", "text").mapInArrow(count_terms, "term string, n0 long, n1 long").groupBy("term")
             .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where((F.col("n1") >= 4) & (odds >= 8.0))
             .orderBy(F.desc(F.col("n1") * F.log(odds)), "term").limit(max_terms).select("term"))
    candidates = [r.term for r in terms.collect()]
    if not candidates or not all0:
        rate = (all1 + 0.5) / (all0 + all1 + 1)
        return Scorer(Matcher([]), np.zeros(0), 0.0, float(np.log(rate / (1 - rate))), spare)

    taken = cover(*_matrix(spark, rows, candidates), candidates)
    matcher = Matcher([candidates[k] for k in taken], [" ".join(words_of(p)) for p in exceptions])
    matcher = Matcher(matcher.terms, matcher.exceptions + _exceptions(spark, rows, matcher))
    return _curve(spark, rows, matcher, all0, all1, spare)


def _matrix(spark, rows: DataFrame, candidates: list[str]):
    """(document, term) pairs of the candidates and the documents' labels (bounded numbers of both)."""
    shared = spark.sparkContext.broadcast({t: k for k, t in enumerate(candidates)})

    def look_up(batches):
        known = shared.value
        for step in text_steps(batches):
            found = [sorted(known[t] for t in terms_of(set(words_of(text))) if t in known) for text in column(step, "text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"mark": column(step, "_mark"), "terms": pa.array(found, pa.list_(pa.int32()))})

    got = rows.select("_mark", "text").mapInArrow(look_up, "mark int, terms array<int>").toArrow()
    toxic = got.column("mark").to_numpy() == 1
    lists = got.column("terms").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(toxic)), lengths), lists.flatten().to_numpy().astype(np.int64), toxic


def _exceptions(spark, rows: DataFrame, matcher: Matcher, least: int = 5, most: int = 1000) -> list[str]:
    """Phrases around a match that at least ``least`` clean rows hold, and at most a tenth as many toxic ones."""
    shared = spark.sparkContext.broadcast(matcher)

    def around(batches):
        for step in text_steps(batches):
            pairs = [(p, m) for m, text in zip(column(step, "_mark").to_pylist(), column(step, "text").to_pylist())
                     for p in shared.value.phrases(words_of(text))]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.string()),
                                              pa.array([m for _, m in pairs], pa.int32())], names=["phrase", "mark"])

    counted = rows.select("_mark", "text").mapInArrow(around, "phrase string, mark int").groupBy("phrase").agg(
        F.sum(1 - F.col("mark")).alias("n0"), F.sum("mark").alias("n1"))
    own = counted.where((F.col("n0") >= least) & (F.col("n1") * 10 <= F.col("n0"))).orderBy(F.desc("n0"), "phrase").limit(most)
    return [r.phrase for r in own.collect()]


def _curve(spark, rows: DataFrame, matcher: Matcher, all0: int, all1: int, spare: float) -> Scorer:
    """Weights from the matches that count, then the curve over the rows' densities."""
    shared = spark.sparkContext.broadcast(matcher)

    def count(batches):
        for step in text_steps(batches):
            found = [words_of(text) for text in column(step, "text").to_pylist()]
            counts = [shared.value.counts(w) for w in found]
            yield pa.RecordBatch.from_pydict({
                "mark": column(step, "_mark"), "words": pa.array([len(w) for w in found], pa.int64()),
                "terms": pa.array([list(c) for c in counts], pa.list_(pa.int32())),
                "counts": pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))})

    got = rows.select("_mark", "text").mapInArrow(
        count, "mark int, words long, terms array<int>, counts array<long>").toArrow()
    toxic = got.column("mark").to_numpy() == 1
    lists = got.column("terms").combine_chunks()
    at = np.repeat(np.arange(len(toxic)), np.diff(lists.offsets.to_numpy()))
    terms = lists.flatten().to_numpy()
    n = got.column("counts").combine_chunks().flatten().to_numpy()
    k = len(matcher.terms)
    n1, n0 = (np.bincount(terms[toxic[at] == v], minlength=k) for v in (True, False))
    weights = np.maximum(np.log((n1 + 0.5) / (all1 + 1) / ((n0 + 0.5) / (all0 + 1))), 0.0)
    weight = np.bincount(at, weights=weights[terms] * n, minlength=len(toxic))
    density = 100 * weight / (got.column("words").to_numpy() + spare)
    return Scorer(matcher, weights, *fit_curve(density, toxic), spare)


def toxicity_scores(docs: DataFrame, labels: DataFrame, cut: float = 0.3, folds: int = 4, held: int = 2,
                    max_labelled: int = 20_000, max_terms: int = 3_000, exceptions: tuple[str, ...] = (),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, tag (xxhash64 of the text), held_out, score, predicted,
    n_words, n_matches.

    ``labels`` has doc_id and toxic (1 toxic, 0 clean; others ignored; an id marked both ways
    is not learned from); ids of the held-out fold are never learned from. The fit uses at
    most ``max_labelled`` labelled rows and looks at ``max_terms`` candidate terms; scoring
    reads every whole text. ``exceptions`` are phrases that excuse a match, besides those
    learned. A null text counts as empty; empty texts get the score of a text without a
    match; rows that repeat an id are scored each on its text. Without labels of both kinds
    all documents get the same score. An empty table gives an empty result; other columns
    are never read.
    """
    rows = id_text(docs, id_col, text_col)
    model = learn(rows, labels, folds, held, max_labelled, max_terms, exceptions)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for step in text_steps(batches):
            words = [words_of(text) for text in column(step, "text").to_pylist()]
            found = [m.matcher.counts(w) for w in words]
            density = np.array([m.density(c, len(w)) for c, w in zip(found, words)], np.float64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": column(step, "doc_id"), "tag": column(step, "tag"), "score": m.score(density),
                "n_words": pa.array([len(w) for w in words], pa.int64()),
                "n_matches": pa.array([sum(c.values()) for c in found], pa.int64())})

    scored = rows.select("doc_id", F.xxhash64("text").alias("tag"), "text").mapInArrow(
        score, "doc_id long, tag long, score double, n_words long, n_matches long")
    return scored.select("doc_id", "tag", in_fold(F.col("doc_id"), folds, held).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"), "n_words", "n_matches")
