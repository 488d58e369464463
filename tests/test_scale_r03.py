"""Steps that move less than they did: what they return stays the same."""

import pytest
from pyspark.sql import functions as F

from quiver.operators import features, sampling, staging, text


def test_customers_are_counted_on_other_rows_than_are_kept(spark):
    kept = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "customer_id string, n int")
    counted = spark.sql("SELECT * FROM VALUES ('a', timestamp'2000-01-01'), ('a', timestamp'2000-01-02'),"
                        " ('b', timestamp'2000-01-01'), ('b', timestamp'2002-01-01'), (NULL, timestamp'2000-01-01') AS t(customer_id, t_dat)")
    out = staging.frequent_customers(kept, "2001-01-01", 2, counted=counted)
    assert sorted(r.n for r in out.collect()) == [1, 2]


def test_small_code_tables_do_not_move_the_rows(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 6), (None, 7)], "a int, b int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = features.categorify(df, ["a", "b"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert {(r.a, r.b): (r.a_code, r.b_code) for r in out.collect()} == {(1, 5): (1, 2), (1, 6): (1, 1), (2, 6): (2, 1), (None, 7): (0, 3)}


@pytest.mark.parametrize("fractions, labels", [((0.8,), ("train", "valid")), ((0.7, 0.9), ("a", "b", "c"))])
def test_split_without_ranks_is_the_ranked_split(spark, fractions, labels):
    for n in (0, 1, 7, 50):
        df = spark.range(n).withColumn("t", F.lit("x"))
        one = sampling.positional_split(df, "id", fractions, labels=labels).select("id", "t", "split")
        two = sampling.split_at_positions(df, "id", fractions, labels=labels)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    many = spark.range(40).select((F.col("id") % 4).alias("id"))  # every cut falls among equal keys
    sizes = lambda d: {r.split: r["count"] for r in d.groupBy("split").count().collect()}
    assert sizes(sampling.split_at_positions(many, "id", fractions, labels=labels)) == \
        sizes(sampling.positional_split(many, "id", fractions, labels=labels))


def test_term_statistics_of_repeated_and_missing_ids(spark):
    rows = [(1, "red red blue", 1), (2, "red green", 0), (2, "red red", 1), (None, "blue blue", 0), (None, "blue", 1),
            (3, None, 1), (4, "the", 0), (5, "green grün green", None)]
    docs = spark.createDataFrame(rows, "doc_id int, t string, y int")
    got = {r.term: (r.df, r.tf, r.n1, r.n0) for r in text.term_statistics(docs, "doc_id", "t", label_col="y").collect()}
    # ids 2 and null are one document each, counted once per row's label; null ids have no label
    assert got == {"red": (2, 5, 5, 3), "blue": (2, 4, 1, 0), "green": (2, 3, 1, 1), "grun": (1, 1, 0, 0)}


def test_best_items_of_factors_are_those_of_brute_force(spark):
    import numpy as np

    from quiver.operators import learn

    rng = np.random.default_rng(3)
    u, v = rng.normal(size=(30, 5)), rng.normal(size=(70, 5))
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "id int, features array<float>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id int, features array<float>")
    got = {r.user: (r["items"], r.scores) for r in learn.factor_topk(users, items, "user", 4).collect()}
    for i, row in enumerate(u.astype(np.float32) @ v.astype(np.float32).T):
        best = np.argsort(-row)[:4]
        assert got[i][0] == best.tolist() and np.allclose(got[i][1], row[best], atol=1e-5)
