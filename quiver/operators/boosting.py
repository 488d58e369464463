"""Boosted trees for several classes with one softmax loss.

Features are cut into bins at their quantiles. A round grows one tree per class, level by
level: every task adds up the gradients and curvatures of its rows by (model, class, node,
feature, bin), one aggregate sums the tasks' tables, and the driver picks the splits from
that table, whose size the parameters bound. All classes, and all folds of a cross
validation, share the same passes. Rows stay where they are; their scores are recomputed
from the trees so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import pin


def feature_cuts(df: DataFrame, features_col: str, bins: int) -> list[list[float]]:
    """Inner bin borders of every feature: its quantiles (approximate), duplicates left out."""
    shares = [k / bins for k in range(1, bins)]
    value = F.col("v").cast("double")
    rows = (df.select(F.posexplode(features_col).alias("j", "v")).where(value.isNotNull() & ~F.isnan(value)).groupBy("j")
            .agg(F.percentile_approx(value, F.array(*[F.lit(s) for s in shares]), 10_000).alias("q")).orderBy("j").collect())
    cuts: list[list[float]] = [[] for _ in range(rows[-1].j + 1)] if rows else []
    for r in rows:
        cuts[r.j] = sorted(set(r.q))
    return cuts


def binned(df: DataFrame, features_col: str, cuts: list[list[float]], *keep: str) -> DataFrame:
    """``bins``: per feature the number of borders below its value; 0 for NULL and NaN."""
    def run(batches):
        borders = [np.asarray(c) for c in cuts]
        for batch in batches:
            out = np.zeros((batch.num_rows, len(borders)), np.int16)
            lists = batch.column(features_col)
            lengths = np.asarray(lists.value_lengths().fill_null(0))
            flat = np.nan_to_num(lists.flatten().to_numpy(zero_copy_only=False), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            at = np.cumsum(lengths) - lengths
            for j, border in enumerate(borders):
                has = lengths > j
                out[has, j] = np.searchsorted(border, flat[at[has] + j], side="left")
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), column], names=[*keep, "bins"])

    own = df.select(*keep, F.transform(features_col, lambda v: v.cast("double")).alias(features_col))
    kinds = dict(df.dtypes)
    return own.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), "bins array<short>"]))


class BoostedTrees:
    """Complete trees of a fixed depth: [round][model, class, node] arrays. A node without a
    split (feature -1) sends all its rows to the left."""

    def __init__(self, models: int, classes: int, depth: int, rate: float, one_vs_rest: bool = False):
        self.models, self.classes, self.depth, self.rate, self.one_vs_rest = models, classes, depth, rate, one_vs_rest
        self.features: list[np.ndarray] = []
        self.cuts: list[np.ndarray] = []
        self.leaves: list[np.ndarray] = []

    def start_round(self) -> None:
        shape = (self.models, self.classes, 2 ** self.depth - 1)
        self.features.append(np.full(shape, -1))
        self.cuts.append(np.zeros(shape, np.int64))
        self.leaves.append(np.zeros((self.models, self.classes, 2 ** self.depth)))

    def node(self, bins: np.ndarray, turn: int, model: int, k: int, level: int) -> np.ndarray:
        """Which node of a level every row is in."""
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for depth in range(level):
            index = at + 2 ** depth - 1
            feature = self.features[turn][model, k][index]
            right = (feature >= 0) & (bins[rows, np.maximum(feature, 0)] > self.cuts[turn][model, k][index])
            at = 2 * at + right
        return at

    def scores(self, bins: np.ndarray, model: int, rounds: int) -> np.ndarray:
        out = np.zeros((len(bins), self.classes))
        for turn in range(rounds):
            for k in range(self.classes):
                out[:, k] += self.leaves[turn][model, k][self.node(bins, turn, model, k, self.depth)]
        return out

    def probabilities(self, bins: np.ndarray, model: int = 0) -> np.ndarray:
        scores = self.scores(bins, model, len(self.leaves))
        return 1 / (1 + np.exp(-2 * scores)) if self.one_vs_rest else _softmax(scores)

    def slopes(self, scores: np.ndarray, label: np.ndarray, turn: int):
        """Gradient and curvature of the loss for every class, given the scores of the rounds before
        ``turn``. One against the rest, as in Spark ML: labels are 1 and -1, the first tree fits them,
        later ones the log loss's residuals, and every row weighs the same."""
        if not self.one_vs_rest:
            p = _softmax(scores)
            for k in range(self.classes):
                yield k, p[:, k] - (label == k), p[:, k] * (1 - p[:, k])
            return
        for k in range(self.classes):
            y = np.where(label == k, 1.0, -1.0)
            yield k, -y if turn == 0 else -4 * y / (1 + np.exp(2 * y * scores[:, k])), np.ones(len(y))


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(batch) -> np.ndarray:
    return batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.int64)


def _histograms(rows: DataFrame, trees: BoostedTrees, level: int, n_features: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and curvatures by (model, class, node, feature, bin)."""
    shape = (trees.models, trees.classes, 2 ** level, n_features, n_bins)
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    done = len(trees.leaves) - 1

    def run(batches):
        t = shared.value
        g, h = np.zeros(shape), np.zeros(shape)
        columns = np.arange(n_features) * n_bins
        for batch in batches:
            bins, label = _matrix(batch), batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for m in range(t.models):
                own = np.flatnonzero(fold != m)
                x = bins[own]
                for k, up, curve in t.slopes(t.scores(x, m, done), label[own], done):
                    cell = (t.node(x, done, m, k, level)[:, None] * n_features * n_bins + columns + x).reshape(-1)
                    for table, weight in ((g, up), (h, curve)):
                        table[m, k] += np.bincount(cell, np.repeat(weight, n_features), 2 ** level * n_features * n_bins).reshape(shape[2:])
        cells = np.flatnonzero(h.reshape(-1))
        yield pa.RecordBatch.from_pydict({"cell": cells, "g": g.reshape(-1)[cells], "h": h.reshape(-1)[cells]})

    got = (rows.mapInArrow(run, "cell long, g double, h double").groupBy("cell")
           .agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas())
    g, h = np.zeros(int(np.prod(shape))), np.zeros(int(np.prod(shape)))
    g[got["cell"].to_numpy()], h[got["cell"].to_numpy()] = got["g"].to_numpy(), got["h"].to_numpy()
    return g.reshape(shape), h.reshape(shape)


def best_splits(g: np.ndarray, h: np.ndarray, penalty: float, least: float):
    """(feature, cut, gradient and curvature of the left and right side) of every (model, class,
    node): the largest gain, of equal ones the first feature and border; feature -1 without one."""
    left_g, left_h = g.cumsum(-1)[..., :-1], h.cumsum(-1)[..., :-1]
    all_g, all_h = g.sum(-1, keepdims=True), h.sum(-1, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    with np.errstate(divide="ignore", invalid="ignore"):  # without a penalty: empty sides, never chosen
        gain = left_g ** 2 / (left_h + penalty) + right_g ** 2 / (right_h + penalty) - all_g ** 2 / (all_h + penalty)
    gain = np.where((left_h >= least) & (right_h >= least), np.round(gain, 9), 0.0)
    flat = gain.reshape(*gain.shape[:3], -1)
    best = flat.argmax(-1)
    borders = gain.shape[-1]
    found = np.take_along_axis(flat, best[..., None], -1)[..., 0] > 1e-9
    feature = np.where(found, best // borders, -1)
    pick = lambda a: np.take_along_axis(a.reshape(*a.shape[:3], -1), best[..., None], -1)[..., 0]
    whole_g, whole_h = all_g[..., 0, 0], all_h[..., 0, 0]
    sides = [(np.where(found, pick(left_g), whole_g), np.where(found, pick(left_h), whole_h)),
             (np.where(found, pick(right_g), 0.0), np.where(found, pick(right_h), 0.0))]
    return feature, best % borders, sides


def fit_boosted(rows: DataFrame, n_features: int, n_bins: int, classes: int, rounds: int = 10, depth: int = 3, rate: float = 0.3,
                penalty: float = 1.0, least: float = 1.0, folds: int = 0, one_vs_rest: bool = False) -> BoostedTrees:
    """Trees over (bins, label, fold). With ``folds``, model f learns from the rows of the other
    folds; without, one model learns from all rows (``fold`` is then -1 everywhere). ``one_vs_rest``
    boosts each class against the others instead of all by one softmax; the first tree then counts whole."""
    trees = BoostedTrees(max(folds, 1), classes, depth, rate, one_vs_rest)
    for _ in range(rounds):
        trees.start_round()
        for level in range(depth):
            g, h = _histograms(rows, trees, level, n_features, n_bins)
            feature, cut, sides = best_splits(g, h, penalty, least)
            at = slice(2 ** level - 1, 2 ** (level + 1) - 1)
            trees.features[-1][:, :, at], trees.cuts[-1][:, :, at] = feature, cut
            if level == depth - 1:
                step = 1.0 if one_vs_rest and len(trees.leaves) == 1 else rate
                for side, (sg, sh) in enumerate(sides):
                    weight = sh + penalty
                    trees.leaves[-1][:, :, side::2] = -step * sg / np.where(weight > 0, weight, 1.0)
    return trees


def prepare(df: DataFrame, features_col: str, label_col: str, fold_col: str | None, bins: int) -> tuple[DataFrame, list[list[float]]]:
    """Pinned (label, fold, bins) rows and the borders of the bins; rows without a label are left out."""
    cuts = feature_cuts(df, features_col, bins) or [[]]  # without any value: one constant feature
    fold = F.lit(-1) if fold_col is None else F.coalesce(F.col(fold_col).cast("int"), F.lit(-1))
    own = df.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("label"), fold.alias("fold"),
                                                       F.col(features_col).alias("features"))
    # few bytes and much work a row: a part for every core
    parts = df.sparkSession.sparkContext.defaultParallelism
    return pin(binned(own, "features", cuts, "label", "fold").repartition(parts)), cuts


def kfold_boosted(df: DataFrame, features_col: str, label_col: str, fold_col: str, classes: int, k: int = 5, rounds: int = 10,
                  depth: int = 3, bins: int = 32, **options) -> DataFrame:
    """(fold, score, loss): accuracy and mean log loss on every fold of the model that learned
    from the others; all folds are fitted in the same passes. Labels are 0 to classes - 1."""
    rows, cuts = prepare(df, features_col, label_col, fold_col, bins)
    trees = fit_boosted(rows, len(cuts), bins, classes, rounds, depth, folds=k, **options)
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            x, fold = _matrix(batch), batch.column("fold").to_numpy(zero_copy_only=False)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for m in np.unique(fold[fold >= 0]).tolist():
                own = fold == m
                p = shared.value.probabilities(x[own], m)
                right = p.argmax(axis=1) == label[own]
                lost = -np.log(np.maximum(p[np.arange(len(p)), label[own]], 1e-7)).sum()
                yield pa.RecordBatch.from_pydict({"fold": pa.array([m], pa.int32()), "hits": [int(right.sum())], "lost": [float(lost)],
                                                  "n": [int(own.sum())]})

    return (rows.mapInArrow(run, "fold int, hits long, lost double, n long").groupBy("fold")
            .agg((F.sum("hits") / F.sum("n")).alias("score"), (F.sum("lost") / F.sum("n")).alias("loss")))
