"""Metric traps: tied scores, constant predictors, empty input, zero division."""

import random

from pyspark.sql import functions as F

from quiver.operators import metrics


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y != 1]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return u / (len(pos) * len(neg))


def test_auc_with_ties_matches_brute_force(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 20) / 4.0, rnd.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, y int")
    got = metrics.roc_auc(df, "score", "y").collect()[0].roc_auc
    assert abs(got - brute_auc(pairs)) < 1e-12


def test_constant_scorer_auc_is_half(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (1.0, 1)], "score double, y int")
    assert metrics.roc_auc(df, "score", "y").collect()[0].roc_auc == 0.5


def test_empty_input_gives_null(spark):
    df = spark.createDataFrame([], "p array<string>, t string")
    r = metrics.hit_rate(df, "p", "t").collect()[0]
    assert r.hit_rate is None and r.n == 0


def test_multiclass_weighted_zero_division(spark):
    # class 2 is never predicted: its precision is 0, not an error
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (1, 0)], "truth int, pred int")
    r = metrics.multiclass_metrics(df, "pred", "truth").collect()[0]
    # per class recall: 0 -> 1/2, 1 -> 1/1, 2 -> 0/1; supports 2, 1, 1
    assert abs(r.recall - (0.5 * 2 + 1 * 1 + 0) / 4) < 1e-12
    assert abs(r.accuracy - r.recall) < 1e-12


def test_precision_at_recall_exact_thresholds(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "s double, y int")
    r = metrics.precision_at_recall(df, "s", "y", 0.96, 0.96).collect()[0]
    assert abs(r.precision_at_recall - 2 / 3) < 1e-12  # both positives need threshold 0.7
    assert r.recall_at_precision == 0.5  # only threshold 0.9 has precision 1


def test_recall_ndcg(spark):
    df = spark.createDataFrame([(["a", "b", "c"], "b"), (["a"], "z")], "items array<string>, target string")
    r = metrics.recall_ndcg(df, "items", "target", 10).collect()[0]
    assert r.recall_at_10 == 0.5
    assert abs(r.ndcg_at_10 - (1 / __import__("math").log2(3)) / 2) < 1e-12


def test_log_loss_clipping(spark):
    df = spark.createDataFrame([(1.0, 0)], "p double, y int")
    r = metrics.binary_log_loss(df, "p", "y").collect()[0]
    assert abs(r.log_loss - (-__import__("math").log(1e-7))) < 1e-6
    assert F is not None


def test_distinct_counts_exact_and_approx(spark):
    from quiver.operators import profile

    df = spark.range(20000).select((F.col("id") % 5000).alias("a"), (F.col("id") % 7).alias("b"))
    exact = profile.distinct_counts(df, ["a", "b"]).collect()[0]
    assert (exact.n_a, exact.n_b) == (5000, 7)
    approx = profile.distinct_counts(df, ["a", "b"], approx=True, rsd=0.02).collect()[0]
    assert abs(approx.n_a - 5000) / 5000 < 0.08 and approx.n_b == 7


def test_best_by_metric_first_wins_and_strict_floor(spark):
    from quiver.operators import profile

    df = spark.createDataFrame([("f", 1, 0.9), ("f", 2, 0.9), ("g", 3, 0.0), ("g", 4, 0.0)],
                               "flow string, run_id int, m double")
    best = {r.flow: r.best_run_id for r in profile.best_by_metric(df, ["flow"], "run_id", "m", "run_id").collect()}
    assert best == {"f": 1, "g": 3}  # ties: the first run wins
    floored = profile.best_by_metric(df, ["flow"], "run_id", "m", "run_id", floor=0.0).collect()
    assert [r.flow for r in floored] == ["f"]  # all-zero scores give no winner
