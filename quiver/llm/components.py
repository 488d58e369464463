"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import pin


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns a, b; longs, no nulls):
    component is the smallest node reachable. Nodes without edges are absent.

    Every step re-hangs neighbours on the smallest one, so the edges end as stars. Each
    step is pinned; the steps stop when a checksum of the edges no longer changes.
    """
    stars = _distinct(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v"))
    mark = None
    while True:
        stars = pin(stars, "star-edges")
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).head()
        if tuple(now) == mark or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = tuple(now)
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = _distinct(large.where("u != v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        stars = _distinct(small)


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u", "v").agg(F.lit(0).alias("_")).select("u", "v")
