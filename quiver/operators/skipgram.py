"""Skip-gram item vectors with hierarchical softmax, trained in parallel parts.

Sequences are numbered, cut and dealt to a fixed number of parts once. An iteration is one
Spark job over all of them: every part starts from the shared vectors and goes through all its
pairs (item, item within the window); Spark averages each row over the parts that moved it.

A task takes the pairs of ``STEP`` centres at a time: how often each input item meets each node
of the Huffman tree is counted first, so that scores and gradients are matrix products over the
distinct items and nodes of the step. Summed gradients are damped by their curvature (rate /
(1 + rate * curvature)), so a node met by every pair of a step moves no further than single
steps would take it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import pin

STEP = 256  # centres whose pairs make one step
_BLOCK = 4096  # centres whose pairs are laid out at a time
_LONGEST = 1000  # longer sequences are cut
_ROWS = 1 << 14  # rows of vectors averaged in one group
_MOVED = pa.schema([("row", pa.int64()), ("vec", pa.binary())])


class Tree:
    """The Huffman tree over items of falling ``counts``: each item's inner nodes and turns."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        total, parent, side = counts.tolist(), np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
        leaf, inner = n - 1, n
        for new in range(n, 2 * n - 1):  # the two lightest of the leaves and nodes left meet
            total.append(0)
            for s in (0, 1):
                if leaf >= 0 and (inner >= new or total[leaf] <= total[inner]):
                    low, leaf = leaf, leaf - 1
                else:
                    low, inner = inner, inner + 1
                parent[low], side[low] = new, s
                total[new] += total[low]
        at, item, runs = np.arange(n if n > 1 else 0), np.arange(n if n > 1 else 0), []
        while len(at):
            runs.append((item, parent[at] - n, side[at]))
            below = parent[at] < 2 * n - 2
            at, item = parent[at][below], item[below]
        item, node, turn = (np.concatenate(x) for x in zip(*runs)) if runs else (np.zeros(0, np.int64),) * 3
        order = np.argsort(item, kind="stable")
        self.nodes, self.turns = node[order], turn[order]
        self.sizes = np.bincount(item, minlength=n)
        self.begin = np.cumsum(self.sizes) - self.sizes


def _runs(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of every run, end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(begin - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """One part's vectors of items (``inputs``) and of tree nodes (``nodes``), changed in place."""

    def __init__(self, inputs: np.ndarray, nodes: np.ndarray, tree: Tree, window: int, rng: np.random.Generator):
        self.inputs, self.nodes, self.tree, self.window, self.rng = inputs, nodes, tree, window, rng
        self.moved = np.zeros(len(inputs), bool), np.zeros(len(nodes), bool)
        self._at = np.zeros(len(inputs), np.int64), np.zeros(len(nodes), np.int64)

    def pairs(self, offsets: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """For the centres at places ``a`` to ``b``: where each one's pairs begin (with the end),
        and the places of the inputs; every centre draws a reach of 1 to ``window``."""
        place = np.arange(a, b)
        reach = self.rng.integers(1, self.window + 1, b - a)
        text = np.searchsorted(offsets, place, side="right") - 1
        first = np.maximum(offsets[text], place - reach)
        sizes = np.minimum(offsets[text + 1] - 1, place + reach) - first
        other = _runs(first, sizes)
        other += other >= np.repeat(place, sizes)
        return np.concatenate([[0], np.cumsum(sizes)]), other

    def train(self, ids: np.ndarray, offsets: np.ndarray, rate_at) -> None:
        """All pairs of the sequences ``ids[offsets[i]:offsets[i + 1]]``; ``rate_at(words)`` is the
        rate after so many words of them."""
        for a in range(0, len(ids), _BLOCK):
            b = min(a + _BLOCK, len(ids))
            begin, other = self.pairs(offsets, a, b)
            for c in range(a, b, STEP):
                d = min(c + STEP, b)
                lo, hi = begin[c - a], begin[d - a]
                if lo < hi:
                    self.step(ids[c:d], np.diff(begin[c - a: d - a + 1]), ids[other[lo:hi]], rate_at(c))

    def step(self, centres: np.ndarray, sizes: np.ndarray, inputs: np.ndarray, rate: float) -> None:
        """The pairs of a few centres with their ``sizes`` inputs each."""
        tree, (item_at, node_at) = self.tree, self._at
        own = np.unique(centres[sizes > 0])
        path = np.unique(tree.nodes[_runs(tree.begin[own], tree.sizes[own])])
        if not len(path):
            return
        items = np.unique(inputs)
        item_at[items], node_at[path] = np.arange(len(items)) * len(path), np.arange(len(path))
        word = np.repeat(centres, sizes)
        each = tree.sizes[word]
        entry = _runs(tree.begin[word], each)
        cells = len(items) * len(path)
        cell = node_at[tree.nodes[entry]] + tree.turns[entry] * cells
        cell += np.repeat(item_at[inputs], each)
        met = np.bincount(cell, minlength=2 * cells).astype(np.float32).reshape(2, len(items), len(path))
        x, y = self.inputs[items], self.nodes[path]
        share = _sigmoid(x @ y.T)
        both = met[0] + met[1]
        both *= share
        push = met[0] - both
        both *= 1 - share  # the curvature
        rate = np.float32(rate)
        by_item = both @ np.einsum("ij,ij->i", y, y)
        by_node = np.einsum("ij,ij->i", x, x) @ both
        self.inputs[items] = x + (push @ y) * (rate / (1 + rate * by_item))[:, None]
        self.nodes[path] = y + (push.T @ x) * (rate / (1 + rate * by_node))[:, None]
        self.moved[0][items], self.moved[1][path] = True, True


def _numbered(seqs: DataFrame, seq_col: str, items, parts: int) -> DataFrame:
    """(ids): known items of every sequence as numbers, in pieces of bounded length, dealt to the parts."""
    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            flat = pc.index_in(lists.flatten(), value_set=items.value)
            row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))[np.asarray(flat.is_valid())]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            cut = np.flatnonzero(place % _LONGEST == 0)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(
                pa.array(np.append(cut, len(row)).astype(np.int32)), flat.drop_null().cast(pa.int32()))], names=["ids"])

    words = F.col(seq_col).cast("array<string>").alias("ids")
    return pin(seqs.select(words).mapInArrow(run, "ids array<int>").repartition(parts))


def _averaged(moved: DataFrame) -> DataFrame:
    """Mean of each row's vectors, in groups of rows of bounded size."""
    def mean(table: pa.Table) -> pa.Table:
        row = table.column("row").to_numpy()
        vecs = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in table.column("vec")])
        order = np.argsort(row, kind="stable")
        first = np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))
        total = np.add.reduceat(vecs[order], first, axis=0, dtype=np.float64)
        total /= np.diff(np.append(first, len(row)))[:, None]
        return pa.table([pa.array(row[order][first]), _packed(total)], schema=_MOVED)

    return moved.groupBy(F.floor(F.col("row") / _ROWS)).applyInArrow(mean, "row long, vec binary")


def _packed(vecs: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in vecs.astype(np.float32)], pa.binary())


def skipgram(seqs: DataFrame, seq_col: str, vector_size: int, window: int, min_count: int, max_iter: int,
             parts: int, seed: int, rate: float = 0.025) -> DataFrame:
    """(item_id, vec) of the items met ``min_count`` times or more; null sequences and items are
    passed over. The items and their vectors are the bound of what the driver and a task hold.
    The rate falls linearly to nearly nothing over all iterations."""
    spark = seqs.sparkSession
    counts = seqs.select(F.explode(F.col(seq_col).cast("array<string>")).alias("item")).where("item is not null") \
        .groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).toArrow() \
        .sort_by([("n", "descending"), ("item", "ascending")])
    items, n = counts.column("item").combine_chunks(), counts.column("n").to_numpy()
    if not len(items):
        raise ValueError(f"no item is met {min_count} times: the vocabulary would be empty")
    known, tree = spark.sparkContext.broadcast(items), spark.sparkContext.broadcast(Tree(n))
    dealt = _numbered(seqs, seq_col, known, parts)
    words, size = int(n.sum()), len(items)
    inputs = ((np.random.default_rng(seed).random((size, vector_size)) - 0.5) / vector_size).astype(np.float32)
    vectors = np.concatenate([inputs, np.zeros((max(size - 1, 0), vector_size), np.float32)])

    for k in range(max_iter):
        start = spark.sparkContext.broadcast(vectors)

        def run(batches, k=k, start=start):
            from pyspark import TaskContext

            rng = np.random.default_rng([seed, k, TaskContext.get().partitionId()])
            own = start.value.copy()
            trainer, seen = Trainer(own[:size], own[size:], tree.value, window, rng), 0
            for batch in batches:
                lists = batch.column("ids")
                ids = lists.flatten().to_numpy().astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
                trainer.train(ids, offsets, lambda at: rate * max(1 - (k + min((seen + at) * parts / words, 1)) / max_iter, 1e-4))
                seen += len(ids)
            rows = np.flatnonzero(np.concatenate(trainer.moved))
            for a in range(0, len(rows), _ROWS):
                some = rows[a: a + _ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(some), _packed(own[some])], schema=_MOVED)

        moved = _averaged(dealt.mapInArrow(run, "row long, vec binary")).toArrow()
        vectors = vectors.copy()
        for row, vec in zip(moved.column("row").chunks, moved.column("vec").chunks):
            vectors[row.to_numpy()] = np.frombuffer(b"".join(vec.to_pylist()), np.float32).reshape(-1, vector_size)
        start.destroy()
    return spark.createDataFrame(pa.table([items, pa.array(list(vectors[:size].astype(np.float64)))], names=["item_id", "vec"]))
