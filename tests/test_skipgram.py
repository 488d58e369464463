"""L01 skip-gram: the tree, pairs and gradients against plain loops, and fits on odd sequences."""

import heapq

import numpy as np
import pyarrow as pa
import pytest

from quiver.operators import learn, skipgram
from quiver.operators.skipgram import Trainer, Tree


@pytest.mark.parametrize("counts", [[1], [5, 5], [9, 4, 4, 3, 1, 1, 1], [1] * 33, [2 ** k for k in range(12, -1, -1)]])
def test_tree_is_a_huffman_tree(counts):
    tree = Tree(np.array(counts))
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        cost += (two := heapq.heappop(heap) + heapq.heappop(heap))
        heapq.heappush(heap, two)
    assert (tree.sizes * counts).sum() == cost
    paths = [tuple(zip(tree.nodes[a: a + n][::-1].tolist(), tree.turns[a: a + n][::-1].tolist())) for a, n in zip(tree.begin, tree.sizes)]
    assert len(set(paths)) == len(counts) and sorted(set(tree.nodes.tolist())) == list(range(len(counts) - 1))
    if len(counts) > 1:
        assert sum(2.0 ** -len(p) for p in paths) == 1 and {p[0][0] for p in paths} == {len(counts) - 2}  # from the root


def _trainer(n=12, dim=5, window=3, seed=4):
    rng = np.random.default_rng(seed)
    return Trainer(rng.standard_normal((n, dim)).astype(np.float32), rng.standard_normal((n - 1, dim)).astype(np.float32),
                   Tree(np.arange(n, 0, -1)), window, rng)


def test_pairs_stay_in_the_window_and_the_sequence():
    t, offsets = _trainer(), np.array([0, 1, 1, 9, 30])
    begin, other = t.pairs(offsets, 0, 30)
    text = np.searchsorted(offsets, np.arange(30), side="right") - 1
    reached = set()
    for p in range(30):
        mine = other[begin[p]: begin[p + 1]].tolist()
        reach = max((abs(x - p) for x in mine), default=0)
        assert mine == [x for x in range(p - reach, p + reach + 1) if 0 <= x < 30 and x != p and text[x] == text[p]]
        reached.add(reach)
    assert reached == {0, 1, 2, 3}


def test_a_step_is_the_sum_of_its_pairs_gradients():
    t = _trainer()
    x, y = t.inputs.astype(np.float64), t.nodes.astype(np.float64)
    centres, sizes = np.array([0, 5, 0, 11, 7]), np.array([2, 3, 1, 0, 2])
    inputs = np.array([1, 2, 1, 1, 3, 9, 0, 4])
    want_x, want_y = np.zeros_like(x), np.zeros_like(y)
    for w, u in zip(np.repeat(centres, sizes), inputs):
        for e in range(t.tree.begin[w], t.tree.begin[w] + t.tree.sizes[w]):
            node, turn = t.tree.nodes[e], t.tree.turns[e]
            g = 1 - turn - 1 / (1 + np.exp(-x[u] @ y[node]))
            want_x[u] += g * y[node]
            want_y[node] += g * x[u]
    rate = 1e-3
    t.step(centres, sizes, inputs, rate)
    assert np.allclose((t.inputs - x) / rate, want_x, atol=0.05) and np.allclose((t.nodes - y) / rate, want_y, atol=0.05)
    assert t.moved[0].tolist() == [k in inputs for k in range(12)]
    assert not t.moved[1][sorted(set(range(11)) - set(t.tree.nodes[np.concatenate([np.arange(a, a + n) for a, n in zip(t.tree.begin[[0, 5, 7]], t.tree.sizes[[0, 5, 7]])])]))].any()


def test_a_step_of_many_equal_pairs_stays_bounded():
    t = _trainer()
    for _ in range(50):
        t.step(np.zeros(1, int), np.array([100_000]), np.zeros(100_000, int), 0.025)
    assert np.abs(t.inputs).max() < 20 and np.abs(t.nodes).max() < 20


def test_every_centre_of_every_sequence_is_trained(monkeypatch):
    t, met = _trainer(), []
    monkeypatch.setattr(t, "step", lambda centres, sizes, inputs, rate: met.extend(np.repeat(centres, sizes > 0).tolist()))
    monkeypatch.setattr(skipgram, "_BLOCK", 64)
    monkeypatch.setattr(skipgram, "STEP", 16)
    ids = np.arange(500) % 12
    t.train(ids, np.array([0, 100, 101, 103, 500]), lambda at: 0.025)
    assert len(met) == 499 and sorted(met) == sorted(np.delete(ids, 100).tolist())  # a lone item has no pairs


def test_neighbours_share_a_group(spark):
    rng = np.random.default_rng(1)
    rows = [([f"g{g}i{rng.integers(10)}" for _ in range(30)],) for g in rng.integers(0, 6, 400)]
    seqs = spark.createDataFrame(rows, "track_sequence array<string>").repartition(3)
    one, two = (sorted(learn.item_embeddings(seqs, vector_size=16, window=5, max_iter=6, partitions=3).collect()) for _ in range(2))
    assert len(one) == 60 and [r.item_id for r in one] == [r.item_id for r in two]
    m = np.array([r.vec for r in one])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = np.argsort(-(m @ m.T - 2 * np.eye(60)), axis=1)[:, :9]
    group = np.array([r.item_id[:2] for r in one])
    assert (group[near] == group[:, None]).mean() > 0.95


def test_nulls_rare_items_and_long_sequences(spark, monkeypatch):
    monkeypatch.setattr(skipgram, "_ROWS", 2)
    rows = [(["a", None, "b", "rare"],), (None,), ([],), (["a", "b", "c"] * 900,), (["c"],)]
    seqs = spark.createDataFrame(rows, "track_sequence array<string>").repartition(2)
    got = {r.item_id: r.vec for r in learn.item_embeddings(seqs, vector_size=4, max_iter=2, partitions=5).collect()}
    assert sorted(got) == ["a", "b", "c"] and all(len(v) == 4 and np.isfinite(v).all() for v in got.values())
    known = spark.sparkContext.broadcast(pa.array(["a", "b", "c"]))
    pieces = [r.ids for r in skipgram._numbered(seqs, "track_sequence", known, 3).collect()]
    assert sorted(map(len, pieces)) == [1, 2, 700, 1000, 1000]


def test_one_item_and_no_item(spark):
    seqs = spark.createDataFrame([(["x", "x", "x"],)], "track_sequence array<string>")
    assert [r.item_id for r in learn.item_embeddings(seqs, vector_size=3, max_iter=2).collect()] == ["x"]
    with pytest.raises(ValueError, match="vocabulary"):
        learn.item_embeddings(seqs, min_count=4)
