"""A 2-D map of items that keeps neighbourhoods.

Items are joined to their nearest neighbours (exact KNN); every round pulls neighbours
together along the edges and pushes all items apart, with the heavy-tailed weight 1 / (1 +
distance^2) of t-SNE (van der Maaten and Hinton 2008). The push does not look at pairs: items
are summed up by the cells of a grid, and an item is pushed by the cells' centres of mass.
The pull is a sum over edge rows, the push one pass over the items with at most
``cells * cells`` cells at hand, so a round is two joins and an aggregate at any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.knn import knn_cosine
from quiver.operators.ranking import pin
from quiver.session import shared_path


def neighbour_edges(items: DataFrame, k: int) -> DataFrame:
    """(item_id, other, weight): the k nearest neighbours both ways round; all weights add up to one."""
    one_way = knn_cosine(items, k=k).select(F.col("query_id").alias("item_id"), F.col("item_id").alias("other"))
    both = one_way.unionByName(one_way.select(F.col("other").alias("item_id"), F.col("item_id").alias("other")))
    counted = pin(both.groupBy("item_id", "other").agg(F.count(F.lit(1)).alias("n")))
    total = counted.select(F.sum("n")).scalar()
    return counted.select("item_id", "other", (F.col("n") / total).alias("weight"))


def grid_cells(places: DataFrame, cells: int) -> np.ndarray:
    """(n, x, y) of the occupied cells of a square grid over all places: counts and centres of mass."""
    box = places.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("x", "y") for f in (F.min, F.max)]).first()
    side = max(box["x_max"] - box["x_min"], box["y_max"] - box["y_min"], 1e-12) * (1 + 1e-9) / cells
    at = [F.floor((F.col(c) - box[f"{c}_min"]) / side) for c in ("x", "y")]
    got = places.groupBy(at[0].alias("i"), at[1].alias("j")).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    return got.select("n", "x", "y").toPandas().to_numpy(np.float64)


def _pushed(places: DataFrame, shared) -> DataFrame:
    """The places with the push (px, py) of all cells on each."""
    def run(batches):
        n, cx, cy, total = shared.value
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
            px, py = np.zeros(len(x)), np.zeros(len(x))
            for a in range(0, len(x), 1024):
                part = slice(a, a + 1024)
                dx, dy = x[part, None] - cx, y[part, None] - cy
                w = n / (1 + dx ** 2 + dy ** 2) ** 2
                px[part], py[part] = (w * dx).sum(1) / total, (w * dy).sum(1) / total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(px), pa.array(py)], names=[*batch.schema.names, "px", "py"])

    return places.mapInArrow(run, "item_id string, x double, y double, vx double, vy double, px double, py double")


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back. A checkpoint would carry the constraints of
    all rounds before along, which the optimizer unfolds."""
    path = shared_path(df.sparkSession, "places")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def neighbour_map(items: DataFrame, start: DataFrame, k: int = 12, rounds: int = 20, cells: int = 48, early: int = 15,
                  pull: float = 12.0) -> DataFrame:
    """(item_id, x, y) of items (item_id, vec), from the places of ``start`` (item_id, x, y): PCA,
    say. In the first ``early`` rounds the pull is ``pull`` times as strong, to gather groups."""
    edges = pin(neighbour_edges(items, k))
    size = start.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.stddev_pop("x"), F.lit(0.0)).alias("s")).first()
    if not size.n:
        return start.select("item_id", "x", "y")
    wide = 10.0 / max(size.s, 1e-12)
    jitter = [(F.pmod(F.xxhash64("item_id", F.lit(c)), F.lit(1 << 20)) / float(1 << 20) - 0.5) * 1e-2 for c in (0, 1)]  # equal vectors part
    places = _stored(start.select(F.col("item_id").cast("string").alias("item_id"), (F.col("x") * wide + jitter[0]).alias("x"),
                              (F.col("y") * wide + jitter[1]).alias("y"), F.lit(0.0).alias("vx"), F.lit(0.0).alias("vy")))
    rate = max(size.n / 12.0, 5.0)
    for turn in range(rounds):
        n, cx, cy = grid_cells(places, cells).T
        near = 1 / (1 + (cx[:, None] - cx) ** 2 + (cy[:, None] - cy) ** 2)
        total = max(float(n @ near @ n - n.sum()), 1e-9)
        shared = places.sparkSession.sparkContext.broadcast((n, cx, cy, total))
        here = places.select("item_id", F.col("x").alias("x0"), F.col("y").alias("y0"))
        there = places.select(F.col("item_id").alias("other"), F.col("x").alias("x1"), F.col("y").alias("y1"))
        dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
        w = F.col("weight") / (1 + dx * dx + dy * dy)
        pulled = (edges.join(here, "item_id").join(there, "other").groupBy("item_id")
                  .agg(F.sum(w * dx).alias("ax"), F.sum(w * dy).alias("ay")))
        strength = pull if turn < early else 1.0
        force = [F.coalesce(F.col(f"a{c}"), F.lit(0.0)) * strength + F.col(f"p{c}") for c in "xy"]
        moved = _pushed(places, shared).join(pulled, "item_id", "left").select(
            "item_id", "x", "y", *[(F.col(f"v{c}") * 0.5 + f * (4 * rate)).alias(f"v{c}") for c, f in zip("xy", force)])
        places = _stored(moved.select("item_id", (F.col("x") + F.col("vx")).alias("x"), (F.col("y") + F.col("vy")).alias("y"), "vx", "vy"))
    return places.select("item_id", "x", "y")


def neighbour_overlap(items: DataFrame, places: DataFrame, k: int = 10) -> DataFrame:
    """One row (overlap, n): the mean share of an item's k nearest neighbours by vector that are
    among its k nearest on the map (squared distances, by inner products of (x, y, 1 and the norm))."""
    from quiver.operators.knn import knn

    true = knn_cosine(items, k=k).select("query_id", "item_id")
    norm = F.col("x") * F.col("x") + F.col("y") * F.col("y")
    asked = places.select(F.col("item_id").alias("query_id"), F.array(2 * F.col("x"), 2 * F.col("y"), F.lit(-1.0)).alias("vec"))
    found = knn(asked, places.select("item_id", F.array("x", "y", norm).alias("vec")), k=k, normalize=False)
    hits = true.join(found.select("query_id", "item_id", F.lit(1).alias("hit")), ["query_id", "item_id"], "left")
    per = hits.groupBy("query_id").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("share"))
    return per.agg(F.avg("share").alias("overlap"), F.count(F.lit(1)).alias("n"))
