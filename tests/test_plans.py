"""Plan-shape checks: the scale properties the operators rely on stay true."""

import contextlib
import io

import pytest

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q(spark):
    import __spark_entry__ as E

    return E.queries()


def test_date_cut_reaches_the_scan(spark, q):
    text = plan_text(q["frequent_customers"](spark, SF))
    assert "LessThan(l_shipdate,2001-01-01T00:00)" in text


def test_columns_are_pruned_at_the_scan(spark, q):
    text = plan_text(q["dedup_transactions"](spark, SF))
    schemas = [line for line in text.splitlines() if "ReadSchema: struct<l_orderkey" in line]
    assert schemas and all("l_comment" not in s and "l_tax" not in s and "l_returnflag" not in s for s in schemas)


def test_dedup_combines_map_side_before_one_shuffle(spark, q):
    tree = plan_text(q["dedup_transactions"](spark, SF)).split("\n\n")[0]
    assert tree.count("ObjectHashAggregate") >= 2  # partial + final around the exchange
    assert "Window" not in tree


def test_knn_runs_in_arrow_batches_without_pairs(spark, q):
    tree = plan_text(q["knn_cosine"](spark, SF)).split("\n\n")[0]
    assert "MapInArrow" in tree
    assert "CartesianProduct" not in tree and "BroadcastNestedLoopJoin" not in tree


@pytest.mark.parametrize("name", ["playlist_sequences", "split_70_20_10", "join_purchases", "encode_splits",
                                  "roc_auc", "coco_annotations", "user_recs", "leaderboard", "next_track"])
def test_no_cartesian_products(spark, q, name):
    tree = plan_text(q[name](spark, SF)).split("\n\n")[0]
    assert "CartesianProduct" not in tree
