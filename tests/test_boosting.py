"""Boosted trees: every split and leaf against plain loops over rows, folds, accuracy, odd values."""

import numpy as np
import pytest

from quiver.operators import boosting


def _data(n=240, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(1)
    y = (x[:, 0] > 0.3).astype(int) + ((x[:, 1] > 0) & (x[:, 0] > 0.3)).astype(int)
    flip = rng.random(n) < 0.1
    y[flip] = rng.integers(0, 3, flip.sum())
    return x, y


def _frame(spark, x, y, folds=None):
    rows = [([None if v is None else float(v) for v in r], int(c), int(f)) for r, c, f in
            zip(x, y, folds if folds is not None else [-1] * len(y))]
    return spark.createDataFrame(rows, "features array<double>, label int, fold int").repartition(4)


def _plain(bins, y, classes, n_bins, rounds, depth, rate=0.3, penalty=1.0, least=1.0):
    """Scores after all rounds, trees grown row by row and split by split."""
    scores = np.zeros((len(y), classes))
    for _ in range(rounds):
        e = np.exp(scores - scores.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        new = scores.copy()
        for k in range(classes):
            g, h = p[:, k] - (y == k), p[:, k] * (1 - p[:, k])

            def grow(rows, level):
                if level == depth:
                    return [(rows, -rate * g[rows].sum() / (h[rows].sum() + penalty))]
                best, split = 1e-9, None
                for j in range(bins.shape[1]):
                    for b in range(n_bins - 1):
                        left = rows[bins[rows, j] <= b]
                        right = rows[bins[rows, j] > b]
                        if h[left].sum() < least or h[right].sum() < least:
                            continue
                        gain = round(g[left].sum() ** 2 / (h[left].sum() + penalty) + g[right].sum() ** 2 / (h[right].sum() + penalty)
                                     - g[rows].sum() ** 2 / (h[rows].sum() + penalty), 9)
                        if gain > best:
                            best, split = gain, (left, right)
                if split is None:
                    return grow(rows, level + 1)
                return grow(split[0], level + 1) + grow(split[1], level + 1)

            for rows, leaf in grow(np.arange(len(y)), 0):
                new[rows, k] += leaf
        scores = new
    return scores


def _binned(spark, x, cuts):
    return np.array([[sum(c < v for c in cuts[j]) for j, v in enumerate(r)] for r in x])


def test_trees_are_those_of_plain_loops(spark):
    x, y = _data()
    rows, cuts = boosting.prepare(_frame(spark, x, y), "features", "label", None, 8)
    trees = boosting.fit_boosted(rows, 4, 8, 3, rounds=4, depth=3)
    bins = _binned(spark, x, cuts)
    assert np.allclose(trees.scores(bins, 0, 4), _plain(bins, y, 3, 8, 4, 3), atol=1e-8)


def test_folds_learn_from_the_others_only(spark):
    x, y = _data(150, 6)
    fold = np.arange(150) % 3
    rows, cuts = boosting.prepare(_frame(spark, x, y, fold), "features", "label", "fold", 6)
    trees = boosting.fit_boosted(rows, 4, 6, 3, rounds=2, depth=2, folds=3)
    bins = _binned(spark, x, cuts)
    hits = {}
    for m in range(3):
        own = fold != m
        assert np.allclose(trees.scores(bins[own], m, 2), _plain(bins[own], y[own], 3, 6, 2, 2), atol=1e-8)
        hits[m] = float((trees.probabilities(bins[~own], m).argmax(1) == y[~own]).mean())
    got = boosting.kfold_boosted(_frame(spark, x, y, fold), "features", "label", "fold", 3, k=3, rounds=2, depth=2, bins=6).collect()
    assert {r.fold: r.score for r in got} == pytest.approx(hits)


def test_learns_and_survives_odd_values(spark):
    x, y = _data(600, 8)
    x = x.astype(object)
    x[::50, 2] = None
    x[1::50, 3] = float("nan")
    x[2::50, 2] = float("inf")
    frame = _frame(spark, x, y, np.arange(600) % 4)
    got = boosting.kfold_boosted(frame, "features", "label", "fold", 3, k=4, rounds=5).collect()
    assert len(got) == 4 and np.mean([r.score for r in got]) > 0.8
    assert boosting.kfold_boosted(frame.where("fold > 9"), "features", "label", "fold", 3, k=4, rounds=1).collect() == []


def _plain_ovr(bins, y, classes, n_bins, rounds, depth, rate):
    """One-vs-rest scores: regression trees on the log loss's residuals, leaves are their means."""
    scores = np.zeros((len(y), classes))
    for k in range(classes):
        sign = np.where(y == k, 1.0, -1.0)
        for turn in range(rounds):
            want = sign if turn == 0 else 4 * sign / (1 + np.exp(2 * sign * scores[:, k]))
            new = scores[:, k].copy()

            def grow(rows, level):
                best, split = 1e-9, None
                for j in range(bins.shape[1] if level < depth else 0):
                    for b in range(n_bins - 1):
                        left, right = rows[bins[rows, j] <= b], rows[bins[rows, j] > b]
                        if len(left) and len(right):
                            gain = round(sum(want[r].sum() ** 2 / len(r) for r in (left, right)) - want[rows].sum() ** 2 / len(rows), 9)
                            if gain > best:
                                best, split = gain, (left, right)
                if split is None:
                    new[rows] += (1.0 if turn == 0 else rate) * want[rows].mean()
                    return
                grow(split[0], level + 1)
                grow(split[1], level + 1)

            grow(np.arange(len(y)), 0)
            scores[:, k] = new
    return scores


def test_one_vs_rest_trees_are_those_of_plain_loops(spark):
    x, y = _data(160, 5)
    fold = np.arange(160) % 2
    rows, cuts = boosting.prepare(_frame(spark, x, y, fold), "features", "label", "fold", 6)
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    trees = boosting.fit_boosted(rows, 4, 6, 3, rounds=3, depth=5, rate=0.1, penalty=0.0, folds=2, one_vs_rest=True)
    bins = _binned(spark, x, cuts)
    for m in range(2):
        own = fold != m
        assert np.allclose(trees.scores(bins[own], m, 3), _plain_ovr(bins[own], y[own], 3, 6, 3, 5, 0.1), atol=1e-8)
    got = boosting.kfold_boosted(_frame(spark, x, y, fold), "features", "label", "fold", 3, k=2, rounds=3, depth=5, bins=6, rate=0.1, penalty=0.0,
                                 one_vs_rest=True).collect()
    hits = {m: float((trees.scores(bins[fold == m], m, 3).argmax(1) == y[fold == m]).mean()) for m in range(2)}
    assert {r.fold: r.score for r in got} == pytest.approx(hits)
