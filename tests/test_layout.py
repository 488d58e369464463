"""Neighbour map: keeps more neighbours than PCA; the grid's push against all pairs; edge rows."""

import numpy as np

from quiver.operators import layout, learn


def _groups(spark, groups=40, each=8, d=24, seed=5):
    rng = np.random.default_rng(seed)
    m = np.repeat(rng.normal(size=(groups, d)), each, axis=0) + 0.15 * rng.normal(size=(groups * each, d))
    rows = [(f"i{j:04d}", [float(v) for v in r]) for j, r in enumerate(m)]
    return spark.createDataFrame(rows, "item_id string, vec array<double>")


def test_overlap_beats_pca(spark):
    items = _groups(spark)
    pca = learn.project_2d(items).checkpoint()
    mapped = layout.neighbour_map(items, pca, k=6, rounds=10)
    overlap = {name: layout.neighbour_overlap(items, p, k=6).first().overlap for name, p in (("pca", pca), ("map", mapped))}
    assert overlap["map"] > overlap["pca"] + 0.1, overlap


def test_push_of_a_fine_grid_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(1)
    p = rng.normal(size=(60, 2)) * 3
    places = spark.createDataFrame([(f"i{k}", float(x), float(y), 0.0, 0.0) for k, (x, y) in enumerate(p)],
                                   "item_id string, x double, y double, vx double, vy double")
    n, cx, cy = layout.grid_cells(places, 4000).T
    assert n.sum() == 60
    got = {r.item_id: (r.px, r.py) for r in layout._pushed(places, spark.sparkContext.broadcast((n, cx, cy, 1.0))).collect()}
    d = p[:, None] - p[None]
    want = (d / (1 + (d ** 2).sum(-1, keepdims=True)) ** 2).sum(1)
    assert np.allclose([got[f"i{k}"] for k in range(60)], want, atol=0.05)


def test_few_items(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0])], "item_id string, vec array<double>")
    start = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 0.0), ("c", 1.0, 1.0)], "item_id string, x double, y double")
    got = layout.neighbour_map(items, start, k=1, rounds=3).collect()
    assert len(got) == 3 and all(np.isfinite([r.x, r.y]).all() for r in got)
    assert len({(r.x, r.y) for r in got}) == 3
    assert layout.neighbour_map(items.limit(0), start.limit(0), rounds=2).collect() == []
