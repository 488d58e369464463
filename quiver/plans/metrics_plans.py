"""Binary metric plans on reviews."""

from __future__ import annotations


from quiver.functions.common import r6
from quiver.operators import metrics
from quiver.plans.registry import plan
from quiver.plans.sqlparts import REVIEWS, with_
from quiver.sources.tables import reviews


@plan("baseline_accuracy", with_(REVIEWS) + """,
c AS (SELECT labels, COUNT(*) AS n FROM reviews GROUP BY labels),
maj AS (SELECT arg_max(labels, n * 1000000 - labels) AS m FROM c)
SELECT 1 AS constant_pred, round(avg((labels = 1)::INTEGER::DOUBLE), 6) AS constant_accuracy,
       (SELECT m FROM maj) AS majority_label,
       round(avg((labels = (SELECT m FROM maj))::INTEGER::DOUBLE), 6) AS majority_accuracy,
       0.5::DOUBLE AS constant_roc_auc FROM reviews""")
def q_baseline_accuracy(spark, sf):
    """Constant-1 and majority-class accuracy; a constant scorer's AUC is 0.5."""
    b = metrics.baseline_accuracy(reviews(spark, sf), "labels", constant=1)
    return b.select("constant_pred", r6("constant_accuracy").alias("constant_accuracy"), "majority_label",
                    r6("majority_accuracy").alias("majority_accuracy"), "constant_roc_auc")


ROC_SQL = """,
bys AS (SELECT score, count(*) FILTER (WHERE labels = 1) AS p, count(*) FILTER (WHERE labels <> 1) AS q
        FROM reviews GROUP BY score),
run AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS below FROM bys)"""


@plan("roc_auc", with_(REVIEWS) + ROC_SQL + """
SELECT round(sum(p * (below + q / 2.0)) / (sum(p) * sum(q)), 6) AS roc_auc,
       sum(p)::BIGINT AS n_pos, sum(q)::BIGINT AS n_neg FROM run""")
def q_roc_auc(spark, sf):
    """Exact ROC AUC with ties of the review score."""
    a = metrics.roc_auc(reviews(spark, sf), "score", "labels")
    return a.select(r6("roc_auc").alias("roc_auc"), "n_pos", "n_neg")


@plan("threshold_accuracy", with_(REVIEWS) + """
SELECT round(avg(((score > 0.5)::INTEGER = labels)::INTEGER::DOUBLE), 6) AS accuracy FROM reviews""")
def q_threshold_accuracy(spark, sf):
    """Accuracy of score > 0.5."""
    a = metrics.threshold_accuracy(reviews(spark, sf), "score", "labels", 0.5)
    return a.select(r6("accuracy").alias("accuracy"))


@plan("precision_at_recall", with_(REVIEWS) + """,
bys AS (SELECT score, count(*) FILTER (WHERE labels = 1) AS p, count(*) FILTER (WHERE labels <> 1) AS q
        FROM reviews GROUP BY score),
run AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(q) OVER (ORDER BY score DESC) AS fp FROM bys),
pr AS (SELECT tp / (tp + fp) AS precision, tp / (SELECT count(*) FROM reviews WHERE labels = 1) AS recall FROM run)
SELECT round(coalesce(max(precision) FILTER (WHERE recall >= 0.96), 0.0), 6) AS precision_at_recall,
       round(coalesce(max(recall) FILTER (WHERE precision >= 0.96), 0.0), 6) AS recall_at_precision FROM pr""")
def q_precision_at_recall(spark, sf):
    """Best precision at recall >= 0.96 and best recall at precision >= 0.96, exact thresholds."""
    m = metrics.precision_at_recall(reviews(spark, sf), "score", "labels", 0.96, 0.96)
    return m.select(*[r6(c).alias(c) for c in m.columns])


@plan("binary_log_loss", with_(REVIEWS) + """
SELECT round(avg(-ln(CASE WHEN labels = 1 THEN least(greatest(score, 1e-7), 1 - 1e-7)
                          ELSE 1 - least(greatest(score, 1e-7), 1 - 1e-7) END)), 6) AS log_loss FROM reviews""")
def q_binary_log_loss(spark, sf):
    """Binary cross-entropy of the review score (clipped 1e-7)."""
    m = metrics.binary_log_loss(reviews(spark, sf), "score", "labels")
    return m.select(r6("log_loss").alias("log_loss"))
