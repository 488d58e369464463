"""Experiment-table plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions.common import r6
from quiver.operators import experiments, profile, sampling
from quiver.plans.registry import plan
from quiver.plans.sqlparts import RUN_RECORDS, RUN_RESULTS, RUNS, with_
from quiver.sources.tables import read_table, run_records, run_results, runs


@plan("latest_successful_run", with_(RUNS) + """
SELECT flow, arg_max(run_id, (created_at, run_id)) AS run_id, max(created_at) AS created_at
FROM runs WHERE successful AND list_contains(tags, 'purchase') GROUP BY flow""")
def q_latest_successful_run(spark, sf):
    """Newest successful run tagged 'purchase' of every flow."""
    return experiments.latest_run(runs(spark, sf), "flow", tag="purchase")


@plan("best_run", with_(RUNS) + """
SELECT flow, arg_max(run_id, (metric, -run_id)) AS best_run_id, max(metric) AS best_metric
FROM runs GROUP BY flow""")
def q_best_run(spark, sf):
    """Arg-max run by metric per flow, the first run winning ties."""
    return profile.best_by_metric(runs(spark, sf), ["flow"], "run_id", "metric", "run_id")


@plan("leaderboard", with_(RUN_RECORDS, RUN_RESULTS) + """,
ok AS (SELECT run_id, flow FROM run_records WHERE successful),
r AS (SELECT rr.*, ok.flow, row_number() OVER (PARTITION BY rr.run_id ORDER BY accuracy DESC, row_idx, model, test_loss) AS rn
      FROM run_results rr JOIN ok ON rr.run_id = ok.run_id)
SELECT run_id, flow, model AS model_name, round(accuracy, 6) AS accuracy, round(test_loss, 6) AS test_loss
FROM r WHERE rn = 1""")
def q_leaderboard(spark, sf):
    """Best result row of every successful run (first row on ties)."""
    # result rows can share an index in the stand-in data: model and loss break those ties
    lb = experiments.leaderboard(run_records(spark, sf), run_results(spark, sf), ["accuracy"],
                                 order_cols=("row_idx", "model", "test_loss"))
    return lb.select("run_id", "flow", "model_name", r6("accuracy").alias("accuracy"),
                     r6("test_loss").alias("test_loss"))


@plan("tag_production", with_(RUN_RECORDS, RUN_RESULTS) + """
SELECT r.run_id, round(max(r.accuracy), 6) AS max_metric, 'production' AS tag
FROM run_results r SEMI JOIN run_records k ON r.run_id = k.run_id AND k.successful
GROUP BY r.run_id HAVING max(r.accuracy) > 0.99""")
def q_tag_production(spark, sf):
    """Successful runs whose best accuracy is above 0.99 get the 'production' tag."""
    t = experiments.tag_runs(run_records(spark, sf), run_results(spark, sf), "accuracy", 0.99)
    return t.select("run_id", r6("max_metric").alias("max_metric"), "tag")


KFOLD_SQL = """
kf AS (SELECT vec_id, label,
              ((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), vec_id) - 1)
               % 5)::INTEGER AS fold FROM embeddings)"""


def _kfold(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", "label")
    return sampling.kfold(e, "label", "vec_id", k=5, seed=42)


@plan("kfold", with_(KFOLD_SQL) + " SELECT vec_id, label, fold FROM kf")
def q_kfold(spark, sf):
    """Stratified 5-fold assignment (seeded order within each label)."""
    return _kfold(spark, sf).select("vec_id", "label", "fold")


@plan("fold_stats", with_(KFOLD_SQL) + """,
c AS (SELECT fold, label, count(*) AS c FROM kf GROUP BY fold, label),
tot AS (SELECT label, count(*) AS t FROM kf GROUP BY label),
g AS (SELECT f.fold, tot.label, tot.t, coalesce(c.c, 0) AS c
      FROM tot CROSS JOIN (SELECT unnest(range(5)) AS fold) f
      LEFT JOIN c ON c.fold = f.fold AND c.label = tot.label),
per AS (SELECT fold, arg_max(label, (t - c, -label)) AS majority, sum(c) AS n FROM g GROUP BY fold),
sc AS (SELECT per.fold, g.c / per.n AS score FROM per JOIN g ON g.fold = per.fold AND g.label = per.majority)
SELECT round_even(avg(score) * 100, 3) AS mean, round_even(stddev_pop(score) * 100, 3) AS std,
       count(*) AS n_folds FROM sc""")
def q_fold_stats(spark, sf):
    """Mean +- population std (x100, 3 decimals) of 5-fold scores of a majority-class model."""
    scores = experiments.fold_majority_scores(_kfold(spark, sf), "label", "fold", 5)
    return experiments.fold_stats(scores)


@plan("sample_per_class", """
WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label
                  ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), vec_id) AS pick FROM embeddings)
SELECT vec_id, label, pick FROM r WHERE pick <= 3""")
def q_sample_per_class(spark, sf):
    """Three items per class without replacement, seeded."""
    e = read_table(spark, sf, "embeddings").select("vec_id", "label")
    return sampling.sample_per_class(e, "label", "vec_id", 3, seed=42).select("vec_id", "label", "pick")


@plan("param_grid", """
WITH o AS (SELECT DISTINCT l_linenumber AS batch_size FROM lineitem),
i AS (SELECT DISTINCT l_discount AS learning_rate FROM lineitem),
p AS (SELECT batch_size, learning_rate,
             row_number() OVER (ORDER BY batch_size, learning_rate) AS grid_pos FROM o CROSS JOIN i)
SELECT batch_size, round(learning_rate, 6) AS learning_rate, grid_pos,
       '{"BATCH_SIZE": ' || batch_size || ', "LEARNING_RATE": ' || learning_rate || '}' AS params,
       md5('{"BATCH_SIZE": ' || batch_size || ', "LEARNING_RATE": ' || learning_rate || '}') AS model_name
FROM p WHERE grid_pos <= 3""")
def q_param_grid(spark, sf):
    """Product of the distinct values of two columns in product
    order, first 3 kept, each as Python-style JSON text with its md5 name."""
    li = read_table(spark, sf, "lineitem")
    g = experiments.param_grid(li.select(F.col("l_linenumber").alias("batch_size")), "batch_size",
                               li.select(F.col("l_discount").alias("learning_rate")), "learning_rate", keep=3)
    js = experiments.python_json([("BATCH_SIZE", F.col("batch_size")), ("LEARNING_RATE", F.col("learning_rate"))])
    return g.select("batch_size", r6("learning_rate").alias("learning_rate"), "grid_pos", js.alias("params"),
                    experiments.param_hash(js).alias("model_name"))


@plan("param_hash", with_(RUNS) + """
SELECT run_id, md5('{"model": "' || tags[1] || '", "flow": ' || flow || '}') AS model_name FROM runs""")
def q_param_hash(spark, sf):
    """md5 of each run's parameter JSON text as its model name."""
    r = runs(spark, sf)
    js = experiments.python_json([("model", F.concat(F.lit('"'), F.element_at("tags", 1), F.lit('"'))),
                                  ("flow", F.col("flow"))])
    return r.select("run_id", experiments.param_hash(js).alias("model_name"))
