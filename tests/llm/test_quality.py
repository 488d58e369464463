"""Quality ranking: the loss, held-out accuracy on the given tables, edge rows."""

import numpy as np
import pyarrow as pa

from quiver.llm.common import read_table
from quiver.llm.quality import NAMES, _threshold, features, fit_bradley_terry, keep_good, quality_scores

from tests.conftest import SF001


def test_weights_minimise_the_pairwise_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    good = x @ np.array([1.0, -2, 0, 0.5, 0]) + rng.normal(size=400) > 0
    w = fit_bradley_terry(x, good, 5000, penalty=0.5)
    assert w[0] > 0.3 and w[1] < -0.6 and abs(w[2]) < 0.4
    up, down = x[good] @ w, x[~good] @ w
    assert (up[:, None] > down[None, :]).mean() > 0.85
    assert (fit_bradley_terry(x, np.ones(400, bool), 100) == 0).all()


def test_threshold_leaves_the_share_of_bad_below():
    raw, good = np.array([3.0, 1, 2, 0]), np.array([True, False, True, False])
    assert _threshold(raw, good) == 1.5


def test_features_of_edge_texts():
    x = features(pa.array(["", " \n", "Aa bb", "|", "é" * 50000]))
    assert x.shape == (5, len(NAMES)) and np.isfinite(x).all() and (x[0] == 0).all()


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rows = quality_scores(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert all((r.score >= 0.3) == (r.predicted == 1) and 0 <= r.score <= 1 for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    from pyspark.sql import functions as F

    from quiver.llm.quality import held_out

    docs, labels = (read_table(spark, SF001, t) for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_edge_rows_and_labels(spark, docs_of):
    rows = [(1, "good words here"), (2, None), (2, ""), (None, "x"), (4, "z" * 10000)]
    labels = spark.createDataFrame([(1, 1), (4, None), (4, 7), (None, 1)], "doc_id long, quality int")
    got = quality_scores(docs_of(rows), labels).collect()  # one kind of label only: all alike
    assert len(got) == 5 and {r.predicted for r in got} == {1} and len({r.score for r in got}) == 1
    assert keep_good(docs_of(rows), labels).count() == 5
    assert keep_good(docs_of(rows), labels).columns == ["doc_id", "text", "keep_id", "n"]
    assert quality_scores(docs_of(rows).where("doc_id > 9"), labels).count() == 0
    assert quality_scores(docs_of(rows), labels.where("doc_id > 9")).count() == 5


def test_repeated_labels_count_once(spark):
    from pyspark.sql import functions as F

    docs, labels = (read_table(spark, SF001, t) for t in ("documents", "labels"))
    torn = labels.limit(5).withColumn("quality", 1 - F.col("quality"))
    without = labels.join(torn.select("doc_id"), "doc_id", "left_anti")
    a, b, c = ({r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (
        without, without.unionByName(without), without.unionByName(labels.limit(5)).unionByName(torn)))
    assert a == b == c


def test_features_and_scores_by_plain_code(spark):
    """Shares, counts and scores recomputed without arrays of texts."""
    import re

    from quiver.llm.quality import Ranker

    texts = ["Aa bb  BB\n\nline | two!!", "the the the", "é ü 12 -- $$", "long" * 9 + " x\ty", "one"]
    x = features(pa.array(texts))
    for row, t in zip(x, texts):
        raw, words, lines = t.encode(), re.findall(r"[^\x20\x09-\x0D]+", t), t.split("\n")
        upper, lower = (len(re.findall(p, t)) for p in ("[A-Z]", "[a-z]"))
        n, size = len(raw), [len(w.encode()) for w in words]
        want = {"upper_share": upper / max(upper + lower, 1), "lower": lower / n, "digit": len(re.findall("[0-9]", t)) / n,
                "pipe": t.count("|") / n, "exclamation": t.count("!") / n, "line_ends": t.count("\n") / n,
                "wide": sum(b >= 128 for b in raw) / n, "log_words": np.log1p(len(words)), "word_length": np.mean(size),
                "long_words": np.mean([s >= 12 for s in size]), "short_words": np.mean([s <= 3 for s in size]),
                "distinct_words": len(set(words)) / len(words),
                "repeated_neighbours": sum(a == b for a, b in zip(words, words[1:])) / len(words),
                "top_word": max(map(words.count, words)) / len(words),
                "bare_marks": np.mean([not re.search(r"[A-Za-z0-9]|[^\x00-\x7f]", w) for w in words]),
                "capital_words": np.mean(["A" <= w[0] <= "Z" for w in words]), "log_lines": np.log1p(len(lines)),
                "distinct_lines": len(set(lines)) / len(lines), "words_per_line": np.log1p(len(words) / len(lines))}
        for name, value in want.items():
            assert abs(row[NAMES.index(name)] - value) < 1e-6, (t, name)
    mean, spread, w = x.mean(0).astype(float), x.std(0).astype(float) + 1e-6, np.linspace(-1, 1, 2 * len(NAMES))
    got = Ranker(mean, spread, w, 0.25, 0.3).score(x.astype(float))
    for s, row in zip(got, x.astype(float)):
        z = [min(max((v - m) / d, -6), 6) for v, m, d in zip(row, mean, spread)]
        raw = sum(a * b for a, b in zip(w, z + [v * v for v in z])) + np.log(0.3 / 0.7) - 0.25
        assert abs(s - 1 / (1 + np.exp(-raw))) < 1e-9


def test_every_labelled_row_is_paired_and_the_threshold_covers_all(spark):
    from quiver.llm.quality import Ranker, _paired, _threshold_of

    n, bad = 260, 60
    rows = [([float(i)] * len(NAMES), int(i >= bad), i + 1) for i in range(n)]
    ranked = spark.createDataFrame(rows, "x array<float>, _good int, _place long")
    met = _paired(ranked, bad, n - bad, 50).collect()
    assert {r.x[0] for r in met} == {float(i) for i in range(bad, n)}  # each good row
    assert {r.y[0] for r in met} == {float(i) for i in range(bad)}  # each bad row
    assert len(_paired(ranked, bad, n - bad, 900).collect()) == 1000  # whole rounds
    width = len(NAMES)
    model = Ranker(np.zeros(width), np.full(width, 100.0), np.r_[1.0, np.zeros(2 * width - 1)], 0.0, 0.3)
    raw = np.arange(n) / 100
    assert abs(_threshold_of(ranked, bad, model) - _threshold(raw, np.arange(n) >= bad)) < 1e-6
