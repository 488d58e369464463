"""Toxicity: folding, the automaton against a plain matcher, exceptions, held-out accuracy, edge rows."""

import random

import numpy as np

from quiver.llm.common import read_table
from quiver.llm.toxicity import Matcher, cover, fit_curve, fold, in_fold, toxicity_scores, words_of


def test_folding():
    assert words_of("1d10t IDIOT іdiot ｉｄｉｏｔ i​diot ídiot") == ["idiot"] * 6
    assert words_of("L0SER! $cum tra$h w0rthle$$, 100 $5 a1") == ["ioser", "scum", "trash", "worthie", "ai"]
    assert words_of("") == [] and fold("12 34") == "12 34"


def _plain(terms, exceptions, words):
    """(term, word number) of the matches that count, by looking at every word."""
    words = [w for i, w in enumerate(words) if not i or words[i - 1] != w]
    out = []
    for i, w in enumerate(words):
        fits = [t for t in terms if (t[:-1] == w if t.endswith(" ") else w.startswith(t))]
        if fits and not any(words[s: s + len(p.split())] == p.split() and s <= i < s + len(p.split())
                            for p in exceptions for s in range(max(0, i - 4), i + 1)):
            out.append((max(fits, key=len), i))
    return out


def test_matches_are_those_of_a_plain_matcher():
    rng = random.Random(4)
    vocabulary = ["aab", "aabb", "aabbc", "bab", "b", "ab", "abc", "cab", "aabbcc"]
    for _ in range(300):
        terms = sorted({rng.choice(vocabulary) + rng.choice(["", " "]) for _ in range(4)})
        exceptions = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3]))) for _ in range(2)]
        words = rng.choices(vocabulary, k=rng.randint(0, 25))
        m = Matcher(terms, exceptions)
        want = _plain(terms, exceptions, words)
        got = m.matches(words)
        assert sorted(m.terms[k] for k, _, _ in got) == sorted(t for t, _ in want)


def test_cover_takes_each_family_once():
    names = ["scum", "scum ", "scu", "moron ", "the "]
    docs = [({0, 1, 2, 4}, 1)] * 20 + [({3, 4}, 1)] * 10 + [({4}, 0)] * 200 + [({2, 4}, 0)] * 3
    rows = np.array([d for d, (t, _) in enumerate(docs) for _ in t])
    terms = np.array([k for t, _ in docs for k in sorted(t)])
    toxic = np.array([y == 1 for _, y in docs])
    assert [names[k] for k in cover(rows, terms, toxic, names)] == ["scum", "moron "]


def test_curve_is_monotone_and_handles_one_kind():
    density = np.array([0.0] * 50 + [3.0] * 20)
    slope, offset = fit_curve(density, density > 0)
    assert slope > 0 and offset < 0
    assert fit_curve(density, np.zeros(70, bool))[0] == 0


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count()
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    caught = np.mean([p for p, t in held if t == 1])
    false = np.mean([p for p, t in held if t == 0])
    assert caught > 0.85 and false < 0.02
    assert all((r.score >= 0.3) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)


def _planted(seed=1):
    rng = random.Random(seed)
    neutral = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(neutral, k=rng.randint(20, 200))
        kind = i % 6
        if kind == 0:  # toxic
            for _ in range(max(2, len(words) // 20)):
                words.insert(rng.randrange(len(words)), rng.choice(["scum", "moron", "trash"]))
        elif kind == 1:  # clean: the exception phrase only
            for _ in range(max(2, len(words) // 20)):
                words.insert(rng.randrange(len(words)), "trash can")
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind == 0)))
    return rows, labels


def test_exceptions_and_obfuscation(spark, docs_of):
    rows, labels = _planted()
    extra = [(1000, "wab wcd $cum wef M0R0N wgh " * 5), (1001, "the trash can wab wcd wef " * 6), (1002, None), (1003, ""),
             (None, "scum " * 9), (1004, "wab wcd " * 30000 + "scum"), (1000, "wab wcd")]
    table = spark.createDataFrame(labels + [(2000, None), (None, 1)], "doc_id long, toxic int")
    got = [(r.doc_id, r.predicted, r.score, r.n_matches) for r in toxicity_scores(docs_of(rows + extra), table).collect()]
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    assert np.mean([p == truth[i] for i, p, _, _ in got if i in truth]) > 0.98
    by = {}
    for i, p, s, n in got:
        by.setdefault(i, []).append((p, n))
    assert sorted(by[1000]) == [(0, 0), (1, 10)]
    assert by[1001] == [(0, 0)] and by[1004][0][0] == 0 and by[None][0][0] == 1
    assert by[1002] == by[1003] == [(0, 0)]


def test_labels_of_the_held_out_fold_change_nothing(spark, docs_of):
    from pyspark.sql import functions as F

    rows, labels = _planted(3)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = table.withColumn("toxic", F.when(in_fold(F.col("doc_id"), 4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity_scores(docs_of(rows), t).collect()} for t in (table, flipped))
    assert a == b


def test_repeated_labels_and_empty_tables(spark, docs_of):
    rows, labels = _planted(5)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    a, b = ({r.doc_id: r.score for r in toxicity_scores(docs_of(rows), t).collect()}
            for t in (table, table.union(table).union(spark.createDataFrame([(9999, 1), (9999, 0)], table.schema))))
    assert a == b
    empty = toxicity_scores(docs_of(rows).where("doc_id < 0"), table)
    assert empty.count() == 0
    none = toxicity_scores(docs_of(rows), table.where("doc_id < 0")).collect()
    assert len(none) == len(rows) and len({r.score for r in none}) == 1
