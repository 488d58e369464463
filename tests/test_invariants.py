"""Invariants for splits, samples, k-folds, the power-law fit, COCO ids,
streaming scoring and the rows-only learning queries."""

import math
import os

import numpy as np
from pyspark.sql import functions as F

from quiver.operators import sampling
from quiver.operators.powerlaw import powerlaw_fit
from quiver.session import shared_path

SF = "/root/testdata/sf0.001"


def test_positional_split_sizes(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    c = {r.split: r["count"] for r in sampling.positional_split(df, "k").groupBy("split").count().collect()}
    assert c == {"train": int(0.7 * 1000), "validate": int(0.9 * 1000) - int(0.7 * 1000), "test": 100}


def test_hash_sample_deterministic_and_bernoulli_zero(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    a = sorted(r.k for r in sampling.hash_sample(df, "k", 10).collect())
    b = sorted(r.k for r in sampling.hash_sample(df, "k", 10).collect())
    assert a == b and 350 < len(a) < 650
    assert sampling.bernoulli_sample(df, 0).count() == 5000


def test_group_split_disjoint(spark):
    rows = [(f"u{i % 37}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "user string, i int")
    s = sampling.group_split(df, "user", 0.8)
    per_user = s.groupBy("user").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in per_user)
    assert s.select("user").filter(F.col("split") == "train").distinct().count() == int(37 * 0.8)


def test_kfold_stratified_balance(spark):
    rows = [(i, i % 3) for i in range(301)]
    df = spark.createDataFrame(rows, "id long, label int")
    f = sampling.kfold(df, "label", "id", k=5)
    sizes = {}
    for r in f.groupBy("label", "fold").count().collect():
        sizes.setdefault(r.label, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 and len(v) == 5 for v in sizes.values())


def test_powerlaw_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    xs = [int(v) for v in np.floor(rng.pareto(1.5, 400) + 1)]
    df = spark.createDataFrame([(v,) for v in xs], "x long")
    got = {r.xmin: r for r in powerlaw_fit(df, "x").collect()}
    vals, counts = np.unique(xs, return_counts=True)
    for xmin in vals[:-1]:
        keep = vals >= xmin
        xt, mt = vals[keep].astype(float), counts[keep].astype(float)
        n = mt.sum()
        alpha = 1 + n / np.sum(mt * np.log(xt / (xmin - 0.5)))
        emp = np.cumsum(mt) / n
        ks = np.max(np.abs(emp - (1 - ((xt + 0.5) / (xmin - 0.5)) ** (1 - alpha))))
        assert math.isclose(got[int(xmin)].alpha, alpha, rel_tol=1e-9)
        assert math.isclose(got[int(xmin)].ks, ks, rel_tol=1e-9, abs_tol=1e-12)
    assert sum(r.is_best for r in got.values()) == 1


def test_coco_ids_dense_and_unique(spark):
    import __spark_entry__ as E

    ann = E.queries()["coco_annotations"](spark, SF)
    ids = sorted(r.id for r in ann.select("id").collect())
    assert ids == list(range(len(ids)))


def test_stream_score_processes_every_file(spark):
    from quiver.streaming.score_stream import stream_score

    src = shared_path(spark, "stream-src")
    spark.range(0, 50).withColumn("v", F.col("id") * 2).write.parquet(src)
    spark.range(50, 80).withColumn("v", F.col("id") * 2).write.mode("append").parquet(src)
    sink, ckpt = shared_path(spark, "stream-sink"), shared_path(spark, "stream-ckpt")
    schema = spark.read.parquet(src).schema
    stream_score(spark, src, schema, lambda b: b.select("id", (F.col("v") + 1).alias("data")), sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == 80 and out.filter(F.col("data") != F.col("id") * 2 + 1).count() == 0
    assert os.path.basename(sink)


def test_learning_queries_shapes(spark):
    import __spark_entry__ as E

    q = E.queries()
    emb = q["item_embeddings"](spark, SF).collect()
    assert emb and all(len(r.vec) == 48 for r in emb)
    auc = q["text_classifier"](spark, SF).collect()[0]
    assert auc.roc_auc is None or 0.0 <= auc.roc_auc <= 1.0
    p2 = q["project_2d"](spark, SF)
    assert p2.columns == ["item_id", "x", "y"] and p2.count() > 0


def test_zero_vector_and_single_class_edges(spark):
    from quiver.functions import vectors as vf
    from quiver.operators import text

    z = spark.createDataFrame([([0.0, 0.0],)], "v array<double>").select(vf.unit("v").alias("u")).collect()[0]
    assert z.u == [0.0, 0.0]
    docs = spark.createDataFrame([(1, "good good fine", 1), (2, "good great", 1)], "doc_id long, review string, y int")
    vocab = text.fit_vocabulary(docs, "doc_id", "review", min_df=0.0, max_df=1.0)
    model = text.fit_naive_bayes(docs, "doc_id", "review", "y", vocab)
    assert model.bias.collect()[0].bias == 0.0
    probs = [r.prob for r in model.score(docs, "doc_id", "review").collect()]
    assert all(0.0 < p < 1.0 for p in probs)


def test_stream_scores_a_table_that_is_a_folder(spark, tmp_path):
    import shutil

    import __spark_entry__ as E

    for t in ("documents", "labels"):
        docs = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        docs.repartition(3 if t == "documents" else 1).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert E.queries()["stream_batch_score"](spark, str(tmp_path)).count() == spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").count()
    shutil.rmtree(tmp_path / "documents.parquet")


def test_profiles_of_a_frame(spark):
    from quiver.operators import profile

    df = spark.createDataFrame([(2, "b", None), (1, None, None)], "id int, s string, x double")
    assert [tuple(r) for r in profile.head(df, ["id"], 1).collect()] == [(1, None, None)]
    assert profile.shape(df).first().asDict() == {"n_rows": 2, "n_columns": 3}
    assert [tuple(r) for r in profile.column_types(df).collect()] == [
        (0, "id", "int", 2), (1, "s", "string", 1), (2, "x", "double", 0)]


def test_nested_values_of_any_length_are_scaled(spark, tmp_path):
    import __spark_entry__ as E

    df = spark.createDataFrame([(1, [1.0] * 100, 0), (2, [2.0] * 3, 1), (3, [], 1), (4, None, 1)],
                               "vec_id long, embedding array<float>, label int")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in E.queries()["nested_scale"](spark, str(tmp_path)).collect())
    assert got == [(1, k, 80.0 if k < 12 else 40.0) for k in range(13)] + [(2, 0, 60.0)]


def test_fallback_guess_is_seeded_and_marked(spark):
    from quiver.functions.vectors import argmax_or_guess

    df = spark.createDataFrame([("a", [0, 1], [0.2, 0.8]), ("b", [0, 1], [0.1, 0.1])], "id string, c array<int>, p array<double>")
    got = {r.id: (r.fallback, r.pred) for r in argmax_or_guess(df, "p", "c", "id").collect()}
    assert got["a"] == (False, 1) and got["b"][0] is True and got["b"][1] in (0, 1)
