"""Lookups with defaults, list extension and the driver contract."""

import pytest

from quiver.operators import recs

SF = "/root/testdata/sf0.001"


def test_lookup_defaults(spark):
    kv_src = spark.createDataFrame([("u1", ["a", "b"], "a")], "customer_id string, items array<string>, target string")
    kv = recs.kv_records(kv_src, "customer_id", 3)
    req = spark.createDataFrame([("u1",), ("u9",), (None,)], "userId string")
    out = {r.userId: r["items"] for r in recs.lookup(req, kv).collect()}
    assert out == {"u1": ["a", "b"], "u9": [], None: ["test_rec_0", "test_rec_1", "test_rec_2"]}


def test_extend_items(spark):
    base = spark.createDataFrame([("a",), ("b",)], "t string")
    cand = spark.createDataFrame([("b",), ("c",), ("d",)], "t string")
    uni = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    assert sorted(r.t for r in recs.extend_items(base, cand, uni, "t").collect()) == ["a", "b", "c"]


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["playlist_id", "artist_sequence", "track_sequence", "track_test_x", "track_test_y"]
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.parametrize("name", ["frequent_customers", "knn_cosine", "roc_auc", "coco_annotations"])
def test_selected_queries_run_on_smallest_data(spark, name):
    import __spark_entry__ as E

    assert E.queries()[name](spark, SF).count() > 0


def test_every_plan_documented_and_oracles_registered():
    from quiver.plans.registry import all_plans

    plans = all_plans()
    assert all((p.fn.__doc__ or "").strip() for p in plans.values())
    assert all(p.sql is None or p.sql.strip() for p in plans.values())
