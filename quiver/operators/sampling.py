"""Sampling and splits."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiver.functions.common import md5_bucket, seeded_hash
from quiver.operators.ranking import global_rank, pin, top_n_per_group


def bernoulli_sample(df: DataFrame, percent: float, seed: int = 42) -> DataFrame:
    """Keep each row with probability percent/100; 0 means no sampling."""
    if not 0 <= percent <= 100:
        raise ValueError("percent must be in [0, 100]")
    if percent in (0, 100):
        return df
    return df.sample(withReplacement=False, fraction=percent / 100.0, seed=seed)


def hash_sample(df: DataFrame, key_col: str, percent: float, seed: int = 42) -> DataFrame:
    """P01 testable twin: keep rows whose md5(key||seed) prefix falls under p %."""
    if not 0 <= percent <= 100:
        raise ValueError("percent must be in [0, 100]")
    if percent == 0:
        return df
    key = F.concat_ws("", F.col(key_col).cast("string"), F.lit(str(seed)))
    threshold = int(percent / 100.0 * 16 ** 8)
    return df.filter(md5_bucket(key) < F.lit(threshold))


def positional_split(df: DataFrame, key_col: str, fractions=(0.7, 0.9), seed: int = 42,
                     labels=("train", "validate", "test")) -> DataFrame:
    """Shuffle by md5(key||seed) and cut at int(f*n) positions.

    Adds ``split`` (and the global ``rank``), one pass, no single-partition window.
    """
    ranked = global_rank(df, [key_col], seed, rank_col="rank", total_col="_n")
    n = F.col("_n").cast("double")
    split = F.when(F.col("rank") <= F.floor(F.lit(float(fractions[0])) * n), labels[0])
    for f, lab in zip(fractions[1:], labels[1:-1]):
        split = split.when(F.col("rank") <= F.floor(F.lit(float(f)) * n), lab)
    split = split.otherwise(labels[-1])
    return ranked.withColumn("split", split).drop("_n")


def split_at_positions(df: DataFrame, key_col: str, fractions=(0.7, 0.9), seed: int = 42,
                       labels=("train", "validate", "test")) -> DataFrame:
    """P02/P07 without the rank, for wide rows: the same split, but only the keys are ranked.
    The driver learns the hash at every cut, and rows are labelled by their own hash where
    they are. Only rows that share a cut's hash (a repeated key) are numbered."""
    ranked = pin(global_rank(df.select(key_col), [key_col], seed, rank_col="_rank", total_col="_n")
                 .select(seeded_hash([key_col], seed).alias("_h"), "_rank", "_n"))
    total = ranked.select(F.max("_n")).first()[0] or 0
    places = [math.floor(float(f) * total) for f in fractions]
    at = [r._h for r in ranked.filter(F.col("_rank").isin(places)).select("_h").distinct().collect()]  # one per cut
    spans = {r._h: r for r in ranked.filter(F.col("_h").isin(at)).groupBy("_h").agg(
        F.min("_rank").alias("first"), F.max("_rank").alias("last")).collect()}
    h = seeded_hash([key_col], seed)

    def labelled(rows, rank_of):
        split = None
        for place, lab in zip(places, labels):
            own = next((s for s in spans.values() if s.first <= place <= s.last), None)
            if own is None:  # no row lies before this cut
                continue
            before = (h < own._h) | ((h == own._h) & (rank_of(own) <= place))
            split = F.when(before, lab) if split is None else split.when(before, lab)
        return rows.withColumn("split", F.lit(labels[-1]) if split is None else split.otherwise(labels[-1]))

    shared = [s._h for s in spans.values() if s.first != s.last]
    if not shared:
        return labelled(df, lambda s: F.lit(s.first))
    numbered = df.filter(h.isin(shared)).withColumn("_place", F.row_number().over(Window.partitionBy(h).orderBy(key_col)))
    return (labelled(df.filter(~h.isin(shared)), lambda s: F.lit(s.first))
            .unionByName(labelled(numbered, lambda s: F.col("_place") + (s.first - 1)).drop("_place")))


def time_split(df: DataFrame, ts_col: str, train_end: str, valid_end: str) -> DataFrame:
    """half-open split ``< train_end`` / ``[train_end, valid_end)`` / ``>= valid_end``."""
    t0 = datetime.strptime(train_end, "%Y-%m-%d")
    t1 = datetime.strptime(valid_end, "%Y-%m-%d")
    if not t1 > t0:
        raise ValueError("valid_end must be after train_end")
    t = F.col(ts_col)
    split = (F.when(t < F.lit(t0), "train")
              .when(t < F.lit(t1), "valid")
              .when(t >= F.lit(t1), "test"))
    return df.withColumn("split", split)


def membership_filter(df: DataFrame, members: DataFrame, col: str, keep: bool = True) -> DataFrame:
    """Semi (or anti) join on one column; duplicates in ``members`` are harmless."""
    return df.join(members.select(col), col, "left_semi" if keep else "left_anti")


def group_split(df: DataFrame, group_col: str, train_frac: float = 0.8, seed: int = 42,
                is_test: bool = False) -> DataFrame:
    """Split by group (user) so no group is on both sides.

    Distinct groups are ranked by md5(group||seed); the first int(frac*n) are
    train. ``is_test=True`` keeps every row (label 'all').
    """
    if is_test:
        return df.withColumn("split", F.lit("all"))
    groups = df.select(group_col).distinct()
    ranked = global_rank(groups, [group_col], seed, rank_col="_gr", total_col="_gn")
    labelled = ranked.select(
        group_col,
        F.when(F.col("_gr") <= F.floor(F.lit(float(train_frac)) * F.col("_gn").cast("double")),
               "train").otherwise("test").alias("split"))
    return df.join(labelled, group_col)


def kfold(df: DataFrame, label_col: str, key_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Stratified fold id: within each label, rows in md5(key||seed) order
    are dealt round-robin to folds 0..k-1."""
    ranked = global_rank(df, [key_col], seed, rank_col="_kr", total_col=None,
                         group_cols=[label_col])
    return ranked.withColumn("fold", ((F.col("_kr") - 1) % k).cast("int")).drop("_kr")


def sample_per_class(df: DataFrame, class_col: str, key_col: str, n: int, seed: int = 42) -> DataFrame:
    """N rows per class without replacement, in md5(key||seed) order."""
    h = F.md5(F.concat_ws("", F.col(key_col).cast("string"), F.lit(str(seed))))
    d = df.withColumn("_sh", h)
    out = top_n_per_group(d, [class_col], ["_sh", key_col], n, rank_col="pick")
    return out.drop("_sh")
