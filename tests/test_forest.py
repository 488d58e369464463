"""Cross-validated forest: subtrees against plain loops, upper nodes against none, odd values."""

import numpy as np
import pytest

from quiver.operators import forest

from test_boosting import _data, _frame


def _plain(x, y, w, asked, classes, depth):
    """Class shares of every asked row's leaf; all features at every node, split by split."""
    out = np.zeros((len(asked), classes))

    def grow(rows, to, level):
        counts = np.bincount(y[rows], w[rows], classes)
        best, split = 1e-9, None
        impure = lambda c: c.sum() - (c ** 2).sum() / c.sum()
        if level < depth and counts.max() < counts.sum():
            for j in range(x.shape[1]):
                for b in range(int(x[:, j].max()) + 1):
                    left, right = rows[x[rows, j] <= b], rows[x[rows, j] > b]
                    if len(left) and len(right):
                        gain = round(impure(counts) - impure(np.bincount(y[left], w[left], classes)) - impure(np.bincount(y[right], w[right], classes)), 9)
                        if gain > best:
                            best, split = gain, (left, right, asked[to, j] <= b)
        if split is None:
            out[to] = counts / counts.sum()
            return
        grow(split[0], to[split[2]], level + 1)
        grow(split[1], to[~split[2]], level + 1)

    grow(np.arange(len(x)), np.arange(len(asked)), 0)
    return out


@pytest.mark.parametrize("depth", [0, 3, 30])
def test_subtrees_are_those_of_plain_loops(depth):
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 8, (150, 3)).astype(np.uint8), rng.integers(0, 3, 150)
    w, asked = rng.integers(1, 4, 150).astype(float), rng.integers(0, 8, (60, 3)).astype(np.uint8)
    got = forest.subtree_votes(x, y, w, asked, 8, 3, 3, depth, rng)
    assert np.allclose(got, _plain(x, y, w, asked, 3, depth))


def test_upper_nodes_change_no_tree(spark):
    # with one feature no node has a choice, so it may not matter where a node is split
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (300, 1)).astype(float)
    y = np.where(rng.random(300) < 0.2, rng.integers(0, 3, 300), x[:, 0].astype(int) % 3)
    frame = _frame(spark, x, y, np.arange(300) % 3)
    run = lambda **o: {r.fold: r.score for r in forest.kfold_forest(frame, "features", "label", "fold", k=3, trees=4, **o).collect()}
    whole = run()
    assert set(whole) == {0, 1, 2} and min(whole.values()) > 0.7
    assert run(task_rows=40) == pytest.approx(whole)


def test_learns_and_survives_odd_values(spark):
    x, y = _data(600, 8)
    x = x.astype(object)
    x[::50, 2] = None
    x[1::50, 3] = float("nan")
    x[2::50, 2] = float("inf")
    frame = _frame(spark, x, y, np.arange(600) % 4)
    got = forest.kfold_forest(frame, "features", "label", "fold", k=4, task_rows=200).collect()
    assert sorted(r.fold for r in got) == [0, 1, 2, 3] and np.mean([r.score for r in got]) > 0.8
    assert forest.kfold_forest(frame.where("fold > 9"), "features", "label", "fold", k=4).collect() == []
    with pytest.raises(ValueError, match="labels"):
        forest.kfold_forest(frame.withColumn("label", -frame["label"]), "features", "label", "fold", k=4)
