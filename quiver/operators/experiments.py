"""Experiment tables: latest runs, leaderboards, tags, fold statistics,
parameter grids (X01-X05, D09, D18, F07, J10, S09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import top_n_per_group


def latest_run(runs: DataFrame, group_col: str = "flow", tag: str | None = None,
               successful_only: bool = True) -> DataFrame:
    """Newest run per flow (by time, then run id), optionally only
    successful ones and only those carrying ``tag``."""
    d = runs
    if successful_only:
        d = d.filter(F.col("successful"))
    if tag is not None:
        d = d.filter(F.array_contains("tags", tag))
    rec = F.max_by(F.struct("run_id", "created_at"), F.struct("created_at", "run_id"))
    return d.groupBy(group_col).agg(rec.alias("_r")).select(group_col, "_r.run_id", "_r.created_at")


def leaderboard(runs: DataFrame, results: DataFrame, metrics: list[str], loss_col: str = "test_loss",
                order_cols: tuple[str, ...] = ("row_idx",)) -> DataFrame:
    """Best result row (first metric, first row on ties) of each successful
    run whose results carry every metric; runs lacking a metric are skipped."""
    ok = runs.filter(F.col("successful")).select("run_id", "flow")
    have = results.groupBy("run_id").agg(*[F.count(m).alias(f"_has_{m}") for m in metrics])
    complete = have.filter(F.expr(" AND ".join(f"_has_{m} > 0" for m in metrics))).select("run_id")
    r = results.join(ok, "run_id").join(complete, "run_id", "left_semi")
    best = top_n_per_group(r, ["run_id"], [F.desc(metrics[0]), *[F.asc(c) for c in order_cols]], 1)
    return best.select("run_id", "flow", F.col("model").alias("model_name"), *metrics, loss_col)


def tag_runs(runs: DataFrame, results: DataFrame, metric: str, threshold: float = 0.99,
             tag: str = "production") -> DataFrame:
    """Successful runs whose best ``metric`` is strictly above the threshold."""
    best = results.groupBy("run_id").agg(F.max(metric).alias("max_metric"))
    ok = runs.filter(F.col("successful")).select("run_id")
    return (best.join(ok, "run_id", "left_semi").filter(F.col("max_metric") > threshold)
                .withColumn("tag", F.lit(tag)))


def fold_majority_scores(df: DataFrame, label_col: str, fold_col: str, k: int) -> DataFrame:
    """Per-fold accuracy of the majority class learned on the other folds
    (a constant classifier evaluated by k-fold cross-validation)."""
    c = df.groupBy(fold_col, label_col).agg(F.count(F.lit(1)).alias("_c"))
    tot = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_t"))
    grid = tot.select(label_col, "_t", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold_col))
    g = grid.join(c, [fold_col, label_col], "left").fillna(0, subset=["_c"])
    g = g.withColumn("_other", F.col("_t") - F.col("_c"))
    per = g.groupBy(fold_col).agg(
        F.max_by(label_col, F.struct("_other", (-F.col(label_col)).alias("_k"))).alias("majority"),
        F.sum("_c").alias("_n"))
    hits = g.select(fold_col, F.col(label_col).alias("majority"), "_c")
    return per.join(hits, [fold_col, "majority"]).select(fold_col, "majority",
                                                         F.try_divide(F.col("_c"), F.col("_n")).alias("score"))


def fold_stats(scores: DataFrame, score_col: str = "score", scale: float = 100.0, decimals: int = 3) -> DataFrame:
    """Mean and population std of fold scores, scaled and rounded half-even."""
    return scores.agg(F.bround(F.avg(score_col) * scale, decimals).alias("mean"),
                      F.bround(F.stddev_pop(score_col) * scale, decimals).alias("std"),
                      F.count(F.lit(1)).alias("n_folds"))


def param_grid(outer: DataFrame, outer_col: str, inner: DataFrame, inner_col: str, keep: int | None = None) -> DataFrame:
    """Cartesian product of two small value sets in product order
    (outer ascending, inner ascending), the first ``keep`` kept.

    The inner set is packed into one array (a scalar subquery) and exploded, so
    no join of the two tables is needed."""
    from quiver.operators.ranking import require_bounded

    distinct_inner = inner.select(inner_col).distinct()
    require_bounded(distinct_inner, 10_000, "parameter grid inner values")
    inner_vals = distinct_inner.select(F.sort_array(F.collect_list(inner_col))).scalar()
    o = outer.select(outer_col).distinct()
    prod = o.select(outer_col, F.posexplode(inner_vals).alias("_ip", inner_col))
    from quiver.operators.ranking import rank_by
    ranked = rank_by(prod, [outer_col, "_ip"], rank_col="grid_pos")
    if keep is not None:
        ranked = ranked.filter(F.col("grid_pos") <= keep)
    return ranked.drop("_ip")


def python_json(pairs: list[tuple[str, Column]]) -> Column:
    """JSON object text laid out like Python's ``json.dumps`` (', ' and ': ')."""
    parts = []
    for i, (k, v) in enumerate(pairs):
        parts.append(F.lit(("" if i == 0 else ", ") + f'"{k}": '))
        parts.append(v.cast("string"))
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def param_hash(json_col) -> Column:
    """Model name = md5 of the parameter JSON text."""
    return F.md5(F.col(json_col) if isinstance(json_col, str) else json_col)
