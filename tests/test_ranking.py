"""Exact distributed ranks and running sums against brute force."""

import hashlib

from pyspark.sql import functions as F

from quiver.operators.ranking import global_rank, rank_by, running_sums, top_n_per_group


def test_global_rank_matches_sorted_md5(spark):
    keys = [f"k{i}" for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r.key: r["rank"] for r in global_rank(df, ["key"], 42).collect()}
    want = sorted(keys, key=lambda k: (hashlib.md5((k + "42").encode()).hexdigest(), k))
    assert [got[k] for k in want] == list(range(1, 301))


def test_rank_by_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    out = sorted((r.v, r["rank"]) for r in rank_by(df, ["v"], partitions=7).collect())
    assert [r for _, r in out] == list(range(1, 1001))


def test_running_sums_per_group(spark):
    rows = [(g, s, (s * 3 + g) % 5) for g in range(3) for s in range(50)]
    df = spark.createDataFrame(rows, "g int, s int, q int")
    out = running_sums(df, "s", ["q"], group_cols=["g"], partitions=5).collect()
    for r in out:
        assert r.before_q == sum(q for g, s, q in rows if g == r.g and s < r.s)


def test_top_n_per_group_skewed_group(spark):
    hot = [("hot", i) for i in range(5000)]
    cold = [("cold", i) for i in range(5)]
    df = spark.createDataFrame(hot + cold, "g string, v int")
    out = top_n_per_group(df, ["g"], [F.desc("v")], 3, rank_col="r").collect()
    got = sorted((r.g, r.v, r.r) for r in out)
    assert got == [("cold", 2, 3), ("cold", 3, 2), ("cold", 4, 1), ("hot", 4997, 3), ("hot", 4998, 2), ("hot", 4999, 1)]


def test_default_partitions(spark):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("v"))
    assert sorted(r["rank"] for r in rank_by(df, ["v"]).collect()) == list(range(1, 201))
    rows = [(g, s, s % 3) for g in range(2) for s in range(20)]
    d = spark.createDataFrame(rows, "g int, s int, q int")
    for r in running_sums(d, "s", ["q"], group_cols=["g"]).collect():
        assert r.before_q == sum(q for g, s, q in rows if g == r.g and s < r.s)


def test_rank_by_many_rows_with_a_payload_read(spark):
    """More rows than the range bounds are sampled from; every rank is checked next to its payload."""
    n = 1_200_000
    df = spark.range(0, n, 1, 8).select((F.col("id") * 7919 % n).alias("v"), F.sha1(F.col("id").cast("string")).alias("pay"))
    out = rank_by(df, ["v"], partitions=8)
    wrong = out.where((F.col("rank") != F.col("v") + 1) | (F.length("pay") != 40))
    assert wrong.count() == 0 and out.select("rank").distinct().count() == n


def test_running_sums_many_rows_with_a_payload_read(spark):
    n = 400_000
    df = spark.range(0, n, 1, 8).select((F.col("id") * 7919 % n).alias("v"), F.lit(1).alias("q"),
                                        F.sha1(F.col("id").cast("string")).alias("pay"))
    out = running_sums(df, "v", ["q"], partitions=8)
    assert out.where((F.col("before_q") != F.col("v")) | (F.length("pay") != 40)).count() == 0


def test_exact_auc_on_many_scores(spark):
    from quiver.operators.metrics import roc_auc

    n = 200_000
    df = spark.range(0, n, 1, 8).select((F.pmod(F.xxhash64("id"), F.lit(n * 4)) / (n * 4.0)).alias("s"),
                                        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("y"))
    pdf = df.toPandas()
    ranks = pdf.s.rank()
    pos = pdf.y == 1
    want = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    got = roc_auc(df, "s", "y").collect()[0][0]
    assert abs(got - want) < 1e-6
