"""Ranking and classification metrics as distributed aggregations.

Score sweeps first aggregate to one row per distinct score (map-side
combined), then use exact running sums spread over range partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.operators.ranking import pin, running_sums

EPS = 1e-7


def accuracy(df: DataFrame, pred_col: str, label_col: str) -> DataFrame:
    """Share of rows where prediction equals label (NULL on empty input)."""
    return df.agg(F.avg((F.col(pred_col) == F.col(label_col)).cast("double")).alias("accuracy"))


def baseline_accuracy(df: DataFrame, label_col: str, constant=1) -> DataFrame:
    """Accuracy of a constant prediction and of the majority class
    (mode, ties to the smaller label); a constant scorer has AUC 0.5."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    majority = counts.select(F.max_by(label_col, F.struct("_n", (-F.col(label_col)).alias("_k")))).scalar()
    return df.agg(
        F.lit(constant).alias("constant_pred"),
        F.avg((F.col(label_col) == F.lit(constant)).cast("double")).alias("constant_accuracy"),
        majority.alias("majority_label"),
        F.avg((F.col(label_col) == majority).cast("double")).alias("majority_accuracy"),
        F.when(F.count(F.lit(1)) > 0, F.lit(0.5)).alias("constant_roc_auc"),
    )


def _score_table(df: DataFrame, score_col: str, label_col: str, group_cols=()) -> DataFrame:
    return (df.groupBy(*group_cols, F.col(score_col).alias("_s"))
              .agg(F.count_if(F.col(label_col) == 1).alias("_p"),
                   F.count_if(F.col(label_col) != 1).alias("_q")))


def roc_auc(df: DataFrame, score_col: str, label_col: str, group_cols: list[str] | None = None) -> DataFrame:
    """Exact binary ROC AUC with ties (Mann-Whitney): for each distinct
    score, positives x (negatives below + half the tied negatives)."""
    g = list(group_cols or [])
    t = running_sums(_score_table(df, score_col, label_col, g), "_s", ["_q"], group_cols=g)
    contrib = F.col("_p") * (F.col("before__q") + F.col("_q") / 2.0)
    agg = t.groupBy(*g).agg(F.sum(contrib).alias("_u"), F.sum("_p").alias("_P"), F.sum("_q").alias("_N"))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_u") / (F.col("_P") * F.col("_N")))
    return agg.select(*g, auc.alias("roc_auc"), F.col("_P").cast("bigint").alias("n_pos"),
                      F.col("_N").cast("bigint").alias("n_neg"))


def threshold_accuracy(df: DataFrame, score_col: str, label_col: str, threshold: float = 0.5) -> DataFrame:
    """Accuracy of ``score > threshold`` (strict) against 0/1 labels."""
    pred = (F.col(score_col) > F.lit(threshold)).cast("int")
    return df.agg(F.avg((pred == F.col(label_col)).cast("double")).alias("accuracy"))


def multiclass_metrics(df: DataFrame, pred_col: str, label_col: str) -> DataFrame:
    """Accuracy, precision, recall, F1 with support-weighted averaging;
    zero division gives 0; weighted accuracy equals weighted recall."""
    cells = pin(df.groupBy(F.col(label_col).alias("_t"), F.col(pred_col).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n")))  # one pass over df; all counts come from its cells
    tp = cells.filter(F.col("_t") == F.col("_p")).select(F.col("_t").alias("_c"), F.col("_n").alias("tp"))
    sup = cells.groupBy(F.col("_t").alias("_c")).agg(F.sum("_n").alias("support"))
    npred = cells.groupBy(F.col("_p").alias("_c")).agg(F.sum("_n").alias("npred"))
    per = (sup.join(npred, "_c", "full").join(tp, "_c", "left")
              .fillna(0, subset=["tp", "support", "npred"]))
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.withColumn("f1_score", f1)
    total = F.sum("support")
    return per.agg(
        (F.sum(F.col("recall") * F.col("support")) / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
        (F.sum(F.col("f1_score") * F.col("support")) / total).alias("f1_score"),
    )


def multiclass_auroc(scores: DataFrame, class_col: str, score_col: str, truth_col: str) -> DataFrame:
    """One-vs-rest AUROC per class, averaged with support weights.

    ``scores`` has one row per (item, class) with that class's score and the
    item's true class."""
    d = scores.withColumn("_is", (F.col(truth_col) == F.col(class_col)).cast("int"))
    per = roc_auc(d, score_col, "_is", group_cols=[class_col])
    return per.agg((F.sum(F.coalesce(F.col("roc_auc"), F.lit(0.0)) * F.col("n_pos")) /
                    F.sum("n_pos")).alias("roc_auc"))


def confusion_matrix(df: DataFrame, pred_col: str, label_col: str, classes: DataFrame) -> DataFrame:
    """Every (true, predicted) pair of class names with its count (0 if none).

    ``classes`` (class_id, class_name) is the class dimension; its list is a
    scalar subquery, so the grid needs no join of the table with itself."""
    from quiver.operators.ranking import require_bounded

    require_bounded(classes, 10_000, "class list")
    names = classes.select(F.sort_array(F.collect_list(F.struct("class_id", "class_name")))).scalar()
    grid = classes.select(F.col("class_id").alias("true_id"), F.col("class_name").alias("true_class"),
                          F.explode(names).alias("_p")).select(
        "true_id", "true_class", F.col("_p.class_id").alias("pred_id"),
        F.col("_p.class_name").alias("pred_class"))
    counts = df.groupBy(F.col(label_col).alias("true_id"), F.col(pred_col).alias("pred_id")).agg(
        F.count(F.lit(1)).alias("n"))
    return (grid.join(counts, ["true_id", "pred_id"], "left")
                .select("true_class", "pred_class", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def pr_sweep(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Precision and recall at every distinct threshold (predict 1 when score >= t)."""
    t = running_sums(_score_table(df, score_col, label_col), "_s", ["_p", "_q"], descending=True)
    tp = F.col("before__p") + F.col("_p")
    fp = F.col("before__q") + F.col("_q")
    npos = df.select(F.count_if(F.col(label_col) == 1)).scalar()
    return t.select(F.col("_s").alias("threshold"),
                    (tp / (tp + fp)).alias("precision"),
                    F.when(npos > 0, tp / npos).alias("recall"))


def precision_at_recall(df: DataFrame, score_col: str, label_col: str,
                        min_recall: float = 0.96, min_precision: float = 0.96) -> DataFrame:
    """Best precision with recall >= r, best recall with precision >= p,
    over exact thresholds; 0 when no threshold qualifies."""
    s = pr_sweep(df, score_col, label_col)
    return s.agg(
        F.coalesce(F.max(F.when(F.col("recall") >= min_recall, F.col("precision"))), F.lit(0.0))
        .alias("precision_at_recall"),
        F.coalesce(F.max(F.when(F.col("precision") >= min_precision, F.col("recall"))), F.lit(0.0))
        .alias("recall_at_precision"))


def binary_log_loss(df: DataFrame, prob_col: str, label_col: str) -> DataFrame:
    """Mean binary cross-entropy, probabilities clipped to [1e-7, 1-1e-7]."""
    p = F.least(F.greatest(F.col(prob_col), F.lit(EPS)), F.lit(1 - EPS))
    pt = F.when(F.col(label_col) == 1, p).otherwise(1 - p)
    return df.agg(F.avg(-F.log(pt)).alias("log_loss"))


def categorical_log_loss(df: DataFrame, probs_col: str, label_col: str) -> DataFrame:
    """Mean categorical cross-entropy of the true class's probability (0-based index)."""
    p = F.element_at(F.col(probs_col), (F.col(label_col) + 1).cast("int"))
    p = F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS))
    return df.agg(F.avg(-F.log(p)).alias("log_loss"))


def two_head_loss(df: DataFrame, probs_col: str, label_col: str, prob_col: str, flag_col: str) -> DataFrame:
    """The loss of a model with two heads: categorical cross-entropy of the first plus binary
    cross-entropy of the second, both means over all rows, in one aggregate."""
    clip = lambda p: F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS))
    first = -F.log(clip(F.element_at(F.col(probs_col), (F.col(label_col) + 1).cast("int"))))
    p = clip(F.col(prob_col))
    second = -F.log(F.when(F.col(flag_col) == 1, p).otherwise(1 - p))
    return df.agg(F.avg(first).alias("class_loss"), F.avg(second).alias("flag_loss"), (F.avg(first) + F.avg(second)).alias("loss"))


def hit(pred_list_col: str, target_col: str):
    """1 when the target is in the predicted list; a missing list or target is a miss."""
    return F.coalesce(F.array_contains(F.col(pred_list_col), F.col(target_col)).cast("int"), F.lit(0))


def hit_rate(df: DataFrame, pred_list_col: str, target_col: str) -> DataFrame:
    """Sum of hits / rows (NULL on empty input)."""
    return df.agg(F.avg(hit(pred_list_col, target_col).cast("double")).alias("hit_rate"),
                  F.count(F.lit(1)).alias("n"))


def recall_ndcg(df: DataFrame, pred_list_col: str, target_col: str, k: int = 10) -> DataFrame:
    """recall@k and NDCG@k with one relevant item: rank r of the target
    in the list; recall = [r <= k], ndcg = 1/log2(r+1). A missing list or target is a miss."""
    r = F.coalesce(F.array_position(F.slice(F.col(pred_list_col), 1, k), F.col(target_col)), F.lit(0))
    return df.agg(
        F.avg((r > 0).cast("double")).alias(f"recall_at_{k}"),
        F.avg(F.when(r > 0, 1.0 / F.log2(r + 1)).otherwise(0.0)).alias(f"ndcg_at_{k}"),
        F.count(F.lit(1)).alias("n"))
