"""Purchase staging traps: try_cast default, default window frame, tie order, splits."""

import datetime as dt

import pytest

from quiver.operators import sampling, staging

D = dt.datetime


def test_safe_double_cast_defaults(spark):
    raw = spark.createDataFrame([("1", "junk", None, "s", "c1", "f", "p"), ("NaN", "2.5", "4.99", "s", "c2", "f", "p")],
                                "Active string, FN string, age string, club_member_status string, customer_id string, "
                                "fashion_news_frequency string, postal_code string")
    out = {r.customer_id: r for r in staging.stage_customers(raw).collect()}
    assert out["c1"].active == 1.0 and out["c1"].fn == 0.0 and out["c1"].age == 0.0
    assert out["c2"].fn == 2.5 and out["c2"].active != out["c2"].active  # NaN kept, as both engines do


def test_dedup_default_frame_only_touches_same_day_rows(spark):
    rows = [(1, "u", 10.0, 1, D(2020, 1, 1)), (1, "u", 12.0, 2, D(2020, 1, 1)), (1, "u", 9.0, 1, D(2020, 1, 2)),
            (1, "u", 9.0, 1, D(2020, 1, 2))]  # exact duplicate
    tx = spark.createDataFrame(rows, "article_id int, customer_id string, price float, sales_channel_id int, "
                               "t_dat timestamp_ntz")
    out = sorted((r.price, r.sales_channel_id, r.t_dat.day) for r in staging.dedup_transactions(tx).collect())
    # duplicates grouped away; both rows of day 1 take the day's last peer (12.0, 2); day 2 stays
    assert out == [(9.0, 1, 2), (12.0, 2, 1), (12.0, 2, 1)]


def test_last_purchase_keeps_one_row(spark):
    rows = [(1, "u", 10.0, 1, D(2020, 1, 1)), (1, "u", 12.0, 2, D(2020, 1, 3)), (1, "u", 9.0, 1, D(2020, 1, 2))]
    tx = spark.createDataFrame(rows, "article_id int, customer_id string, price float, sales_channel_id int, "
                               "t_dat timestamp_ntz")
    out = staging.last_purchase(tx).collect()
    assert len(out) == 1 and out[0].price == 12.0


def test_time_split_half_open_and_order_check(spark):
    df = spark.createDataFrame([(D(2020, 9, 7),), (D(2020, 9, 8),), (D(2020, 9, 15),)], "t timestamp_ntz")
    out = [r.split for r in sampling.time_split(df, "t", "2020-09-08", "2020-09-15").orderBy("t").collect()]
    assert out == ["train", "valid", "test"]
    with pytest.raises(ValueError):
        sampling.time_split(df, "t", "2020-09-15", "2020-09-08")


def test_span_counts_use_real_dates(spark):
    df = spark.createDataFrame([("c", D(2018, 9, 21)), ("c", D(2018, 12, 31)), (None, D(2018, 9, 20))],
                               "customer_id string, t_dat timestamp_ntz")
    out = {r.end_date: r.n_rows for r in staging.span_counts(df, "2018-09-20", ["2018-09-22"]).collect()}
    assert out == {"2018-09-22": 1}  # NULL id not counted; December is outside the span
