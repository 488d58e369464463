"""Random forests scored by cross validation (L08) whose trees never meet in one place.

Fully grown trees have about as many nodes as there are rows, so a forest grows with its
input. Features are cut into bins at their quantiles. While a node holds more than
``task_rows`` rows, every task adds up its rows' classes by (fold, tree, node, feature, bin),
and the sums are split where they meet, one row per node. The driver keeps those few upper
nodes. Every smaller node is a group of rows: one task grows its subtree, sends the held-out
rows through it and returns their votes only. Votes are added up by row in Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.boosting import binned, feature_cuts
from quiver.operators.ranking import pin

_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)]))  # of mean 1
_CELLS = 1 << 19  # sums held at a time while a subtree grows


def _draws(ids: np.ndarray, *key: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson numbers of mean 1, by hash of row and key."""
    x = ids.astype(np.uint64) + np.uint64(hash(key) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15), (30, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)) / 2.0 ** 53, side="right")


def _chosen(rng: np.random.Generator, nodes: int, n_features: int, take: int) -> np.ndarray:
    """``take`` random features of every node."""
    return np.sort(rng.random((nodes, n_features)).argsort(axis=1)[:, :take], axis=1)


def _sums(x, y, w, node, features, n_bins: int, classes: int) -> np.ndarray:
    """(node, chosen feature, bin, class) sums of the weights."""
    nodes, take = features.shape
    mine = x[np.arange(len(x))[:, None], features[node]].astype(np.int64)
    cell = ((node[:, None] * take + np.arange(take)) * n_bins + mine) * classes + y[:, None]
    return np.bincount(cell.reshape(-1), np.repeat(w, take), nodes * take * n_bins * classes).reshape(nodes, take, n_bins, classes)


def _splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the place of the chosen feature (-1: no split lowers the Gini impurity), the last bin
    of the left side, and the class sums of both sides; of equal gains the first."""
    left = sums.cumsum(axis=2)
    whole = left[:, :, -1:, :]
    left, right = left[:, :, :-1], whole - left[:, :, :-1]
    n_left, n_right, n = left.sum(-1), right.sum(-1), whole.sum(-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left ** 2).sum(-1) / n_left + (right ** 2).sum(-1) / n_right - (whole ** 2).sum(-1) / n
    gain = np.where((n_left > 0) & (n_right > 0), np.round(gain, 9), 0.0).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    at, borders = np.arange(len(sums)), left.shape[2]
    place, cut = best // borders, best % borders
    found = gain[at, best] > 1e-9
    return np.where(found, place, -1), cut, left[at, place, cut], right[at, place, cut]


def subtree_votes(x: np.ndarray, y: np.ndarray, w: np.ndarray, asked: np.ndarray, n_bins: int, classes: int, take: int, depth: int,
                  rng: np.random.Generator) -> np.ndarray:
    """Grow a tree of at most ``depth`` levels on the rows (x, y, weight w), level by level, and
    return the class shares of the leaf that each row of ``asked`` comes to."""
    votes = np.zeros((len(asked), classes))
    node, to = np.zeros(len(x), np.int64), np.zeros(len(asked), np.int64)
    rows, left_over = np.arange(len(x)), np.arange(len(asked))
    counts = np.bincount(y, w, classes)[None, :]
    step = max(1, _CELLS // (take * n_bins * classes))
    for level in range(depth + 1):
        total = counts.sum(axis=1, keepdims=True)
        votes[left_over] = (counts / np.maximum(total, 1))[to]  # the last node that a row comes to stays
        inner = (counts.max(axis=1) < total[:, 0]) if level < depth else np.zeros(len(counts), bool)
        number = np.cumsum(inner) - 1
        keep = inner[node]
        rows, node = rows[keep], number[node[keep]]
        keep = inner[to]
        left_over, to = left_over[keep], number[to[keep]]
        nodes = int(inner.sum())
        if nodes == 0:
            break
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        sides = np.zeros((nodes, 2, classes))
        for a in range(0, nodes, step):
            b = min(a + step, nodes)
            features = _chosen(rng, b - a, x.shape[1], take)
            some = slice(*np.searchsorted(node, (a, b)).tolist())
            mine = rows[some]
            place, cut[a:b], sides[a:b, 0], sides[a:b, 1] = _splits(_sums(x[mine], y[mine], w[mine], node[some] - a, features, n_bins, classes))
            feature[a:b] = np.where(place >= 0, features[np.arange(b - a), np.maximum(place, 0)], -1)
        split = feature >= 0  # the others are leaves, their rows have voted
        number = np.cumsum(split) - 1
        keep = split[node]
        rows, node = rows[keep], node[keep]
        node = 2 * number[node] + (x[rows, feature[node]] > cut[node])
        keep = split[to]
        left_over, to = left_over[keep], to[keep]
        to = 2 * number[to] + (asked[left_over, feature[to]] > cut[to])
        counts = sides[split].reshape(-1, classes)
        if not len(counts):
            break
    return votes


class UpperTrees:
    """The upper nodes of every (fold, tree): those with more rows than a task takes. ``group`` is
    the number of an end's rows, -1 for an inner node and for a leaf, which has ``shares``."""

    def __init__(self, folds: int, trees: int):
        self.folds, self.trees, self.groups, self.levels = folds, trees, 0, []
        self.of = {(m, t): {"feature": [-1], "cut": [0], "left": [0], "group": [-1], "shares": [None], "level": [0]}
                   for m in range(folds) for t in range(trees)}

    def end(self, m: int, t: int, node: int) -> None:
        tree = self.of[m, t]
        tree["group"][node] = self.groups
        self.levels.append(tree["level"][node])
        self.groups += 1

    def split(self, m: int, t: int, node: int, feature: int, cut: int) -> tuple[int, int]:
        tree = self.of[m, t]
        first = len(tree["feature"])
        tree["feature"][node], tree["cut"][node], tree["left"][node] = feature, cut, first
        for _ in range(2):
            for name, value in (("feature", -1), ("cut", 0), ("left", 0), ("group", -1), ("shares", None), ("level", tree["level"][node] + 1)):
                tree[name].append(value)
        return first, first + 1

    def node(self, m: int, t: int, x: np.ndarray) -> np.ndarray:
        tree = self.of[m, t]
        at = np.zeros(len(x), np.int64)
        feature, cut, left = (np.asarray(tree[c]) for c in ("feature", "cut", "left"))
        while True:
            go = np.flatnonzero(feature[at] >= 0)
            if not len(go):
                return at
            here = at[go]
            at[go] = left[here] + (x[go, feature[here]] > cut[here])


def _columns(batch):
    x = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.uint8)
    return (x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold", "id")))


def _grow_upper(rows: DataFrame, upper: UpperTrees, open_nodes: list, n_bins: int, classes: int, take: int, depth: int, task_rows: int,
                seed: int) -> None:
    """Split every open node (m, t, node) and what comes of it until a task takes its rows."""
    spark = rows.sparkSession
    sample = lambda m, t, node, n: _chosen(np.random.default_rng((seed, m, t, node)), 1, n, take)
    while open_nodes:
        shared = spark.sparkContext.broadcast((upper, sorted(open_nodes)))

        def add(batches):
            trees, nodes = shared.value
            total: dict = {}
            for batch in batches:
                x, y, fold, ids = _columns(batch)
                for m, t in sorted({n[:2] for n in nodes}):
                    w = np.where(fold != m, _draws(ids, seed, m, t), 0)
                    at = trees.node(m, t, x)
                    for node in [n[2] for n in nodes if n[:2] == (m, t)]:
                        own = np.flatnonzero((at == node) & (w > 0))
                        got = _sums(x[own], y[own], w[own], np.zeros(len(own), np.int64), sample(m, t, node, x.shape[1]), n_bins, classes)
                        total[m, t, node] = total.get((m, t, node), 0) + got
            for (m, t, node), sums in total.items():
                yield pa.RecordBatch.from_pydict({"m": pa.array([m], pa.int32()), "t": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()),
                                                  "sums": pa.array([sums.tobytes()], pa.binary())})

        def choose(table: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(s.as_buffer()) for s in table.column("sums")).reshape(1, take, n_bins, classes)
            place, cut, left, right = _splits(sums)
            return pa.table({**{c: table.column(c)[:1] for c in ("m", "t", "node")}, "place": pa.array(place, pa.int32()),
                             "cut": pa.array(cut, pa.int32()), "whole": pa.array([sums[0, 0].sum(axis=0).tolist()], pa.list_(pa.float64())),
                             "l": pa.array([left[0].tolist()], pa.list_(pa.float64())), "r": pa.array([right[0].tolist()], pa.list_(pa.float64()))})

        found = rows.mapInArrow(add, "m int, t int, node int, sums binary").groupBy("m", "t", "node").applyInArrow(
            choose, "m int, t int, node int, place int, cut int, whole array<double>, l array<double>, r array<double>").collect()
        n_features = len(rows.select("bins").first().bins)
        open_nodes = []
        for r in sorted(found, key=lambda r: (r.m, r.t, r.node)):
            if r.place < 0:
                upper.of[r.m, r.t]["shares"][r.node] = (np.asarray(r.whole) / sum(r.whole)).tolist()
                continue
            feature = int(sample(r.m, r.t, r.node, n_features)[0, r.place])
            for child, counts in zip(upper.split(r.m, r.t, r.node, feature, r.cut), (r.l, r.r)):
                if max(counts) == sum(counts) or upper.of[r.m, r.t]["level"][child] >= depth:
                    upper.of[r.m, r.t]["shares"][child] = (np.asarray(counts) / sum(counts)).tolist()
                elif sum(counts) > task_rows:
                    open_nodes.append((r.m, r.t, child))
                else:
                    upper.end(r.m, r.t, child)


def kfold_forest(df: DataFrame, features_col: str, label_col: str, fold_col: str, k: int = 5, trees: int = 10, depth: int = 30,
                 bins: int = 32, seed: int = 42, task_rows: int = 100_000) -> DataFrame:
    """(fold, score): accuracy on every fold of a random forest that learned from the others.

    Trees are grown on rows drawn with replacement, on the square root of the features' number
    (rounded up) at every node, until no split lowers the Gini impurity or ``depth`` is reached;
    a forest's vote is the sum of its leaves' class shares. Labels are 0 to 99; rows without one
    are left out. ``task_rows`` only bounds what one task grows."""
    spark = df.sparkSession
    cuts = feature_cuts(df, features_col, bins) or [[]]  # without any value: one constant feature
    own = df.where(F.col(label_col).isNotNull()).select(F.col(label_col).cast("int").alias("label"), F.col(fold_col).cast("int").alias("fold"),
                                                       F.monotonically_increasing_id().alias("id"), F.col(features_col).alias("features"))
    # the rows are few for the work on them: a part for every core
    rows = pin(binned(own, "features", cuts, "label", "fold", "id").repartition(spark.sparkContext.defaultParallelism))
    sizes = {r.fold: r for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).collect()}
    if any(r.low < 0 or r.high > 99 for r in sizes.values()):
        raise ValueError("labels must be 0 to 99")
    classes = max([r.high + 1 for r in sizes.values()], default=1)
    n, take = sum(r.n for r in sizes.values()), int(np.ceil(np.sqrt(len(cuts))))

    upper = UpperTrees(k, trees)
    roots = [(m, t, 0) for m in range(k) for t in range(trees)]
    large = [r for r in roots if n - (sizes[r[0]].n if r[0] in sizes else 0) > task_rows]
    for m, t, node in sorted(set(roots) - set(large)):
        upper.end(m, t, node)
    _grow_upper(rows, upper, large, bins, classes, take, depth, task_rows, seed)
    shared = spark.sparkContext.broadcast(upper)

    def deal(batches):
        """A row goes to its node's group in each tree that draws it or that it is held out of."""
        for batch in batches:
            x, y, fold, ids = _columns(batch)
            for m in range(k):
                for t in range(trees):
                    w = np.where(fold == m, 0, _draws(ids, seed, m, t))
                    mine = np.flatnonzero((fold == m) | (w > 0))
                    tree = shared.value.of[m, t]
                    at = shared.value.node(m, t, x[mine])
                    group = np.asarray(tree["group"])[at]
                    to = np.flatnonzero(group >= 0)
                    yield _dealt(group[to], ids[mine[to]], y[mine[to]], fold[mine[to]], w[mine[to]], x[mine[to]], None)
                    out = np.flatnonzero((group < 0) & (w[mine] == 0))  # held-out rows in a leaf have their vote
                    yield _dealt(np.full(len(out), -1), ids[mine[out]], y[mine[out]], fold[mine[out]], w[mine[out]], None,
                                 [tree["shares"][i] for i in at[out].tolist()])

    def vote(batches):
        held: dict[int, list] = {}
        for batch in batches:
            group = batch.column("part").to_numpy()
            for g in np.unique(group).tolist():
                some = batch if (group == g).all() else batch.filter(pa.array(group == g))
                held.setdefault(g, []).append(some.select(["id", "label", "fold", "w", "bins"]))
        for g in sorted(held):  # one, unless the session has fewer parts than groups
            table = pa.Table.from_batches(held.pop(g)).sort_by("id")  # the same tree in whatever order rows arrive
            y, fold, w, ids = (table.column(c).to_numpy() for c in ("label", "fold", "w", "id"))
            x = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(table.num_rows, -1)
            train, ask = np.flatnonzero(w > 0), np.flatnonzero(w == 0)
            shares = subtree_votes(x[train], y[train].astype(np.int64), w[train].astype(float), x[ask], bins, classes, take,
                                   depth - shared.value.levels[g], np.random.default_rng((seed, g)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[ask]), pa.array(y[ask]), pa.array(fold[ask]), pa.array(shares.tolist(), pa.list_(pa.float64()))],
                                             names=["id", "label", "fold", "shares"])

    fields = "part int, id long, label int, fold int, w int, bins binary, shares array<double>"
    dealt = rows.mapInArrow(deal, fields)
    votes = (dealt.where("part >= 0").select("part", "id", "label", "fold", "w", "bins")
             .repartitionById(max(upper.groups, 1), "part").mapInArrow(vote, "id long, label int, fold int, shares array<double>"))
    if any(s is not None for tree in upper.of.values() for s in tree["shares"]):
        votes = votes.unionByName(dealt.where("part < 0").select("id", "label", "fold", "shares"))
    sums = votes.groupBy("id", "label", "fold").agg(F.array(*[F.round(F.sum(F.col("shares")[c]), 9) for c in range(classes)]).alias("s"))
    right = (F.array_position("s", F.array_max("s")) - 1 == F.col("label")).cast("double")
    return sums.groupBy("fold").agg(F.avg(right).alias("score"))


def _dealt(group, ids, y, fold, w, x, shares) -> pa.RecordBatch:
    n = len(ids)
    bins = pa.nulls(n, pa.binary()) if x is None else pa.array([r.tobytes() for r in x], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(group.astype(np.int32)), pa.array(ids), pa.array(y.astype(np.int32)), pa.array(fold.astype(np.int32)), pa.array(w.astype(np.int32)), bins,
         pa.array(shares, pa.list_(pa.float64())) if shares is not None else pa.nulls(n, pa.list_(pa.float64()))],
        names=["part", "id", "label", "fold", "w", "bins", "shares"])
