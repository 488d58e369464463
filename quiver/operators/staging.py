"""Typed staging, dedup, joins and filters of the purchase pipeline
(B01-B03, B06, B07, F01, F03, J01, J02, D01, D07, W01, W02, W05)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARTICLE_INT_COLS = ["article_id", "product_code", "product_type_no", "graphical_appearance_no",
                    "colour_group_code", "perceived_colour_value_id", "perceived_colour_master_id",
                    "department_no", "index_group_no", "section_no", "garment_group_no"]
ARTICLE_COLS = ["article_id", "product_code", "product_type_no", "product_group_name",
                "graphical_appearance_no", "colour_group_code", "perceived_colour_value_id",
                "perceived_colour_master_id", "department_no", "index_code", "index_group_no",
                "section_no", "garment_group_no"]
CUSTOMER_COLS = ["active", "fn", "age", "club_member_status", "customer_id",
                 "fashion_news_frequency", "postal_code"]
TX_COLS = ["price", "sales_channel_id", "t_dat"]


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Every column name lower-cased."""
    return df.toDF(*[c.lower() for c in df.columns])


def stage_articles(raw: DataFrame) -> DataFrame:
    """The 13 article columns with strict casts (a bad value fails the job)."""
    return raw.select(*[
        F.col(c).cast("int" if c in ARTICLE_INT_COLS else "string").alias(c) for c in ARTICLE_COLS
    ])


def stage_customers(raw: DataFrame) -> DataFrame:
    """``coalesce(try_cast(x as double), 0.0)`` on active/fn/age, strings kept."""
    def safe_double(c):
        return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c.lower())
    return raw.select(
        safe_double("Active"), safe_double("FN"), safe_double("age"),
        F.col("club_member_status").cast("string").alias("club_member_status"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("fashion_news_frequency").cast("string").alias("fashion_news_frequency"),
        F.col("postal_code").cast("string").alias("postal_code"),
    )


def stage_transactions(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``article_id::INT, customer_id::VARCHAR, price::FLOAT,
    sales_channel_id::INT, t_dat::TIMESTAMP``; ``keep`` passes tie columns through.
    The view-level ORDER BY of the source has no meaning and is not applied."""
    return raw.select(
        F.col("article_id").cast("int").alias("article_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("price").cast("float").alias("price"),
        F.col("sales_channel_id").cast("int").alias("sales_channel_id"),
        F.col("t_dat").cast("timestamp_ntz").alias("t_dat"),
        *keep,
    )


def dedup_transactions(tx: DataFrame) -> DataFrame:
    """D07+W01, the literal model: GROUP BY all five columns, then
    ``last_value(..) over (partition by article, customer order by t_dat)`` with
    the default frame (RANGE .. CURRENT ROW).

    The frame ends at the last *peer* of the current day, so only same-day rows
    change: each takes the values of the day's last row. The engine leaves the
    order among same-day peers open; here it is (price, sales_channel_id), the
    only columns left after grouping, so the result is deterministic.

    One aggregate keyed on (article, customer, day) does both steps: the
    distinct (price, channel) pairs are a ``collect_set`` (deduplicated
    map-side before the single shuffle) and the day's last peer is the
    largest of the merged set; the set is exploded back to one row per distinct pair.
    """
    keys = ["article_id", "customer_id", "t_dat"]
    per_day = tx.groupBy(*keys).agg(F.collect_set(F.struct("price", "sales_channel_id")).alias("_pairs"))
    rows = per_day.select(*keys, F.array_max("_pairs").alias("_last"), F.explode("_pairs").alias("_p"))
    return rows.select(
        "article_id", "customer_id",
        F.col("_last.price").alias("price"),
        F.col("_last.sales_channel_id").alias("sales_channel_id"),
        "t_dat",
    )


def last_purchase(tx: DataFrame, tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """W02, the documented intent: one row per (article, customer), its last
    purchase by (t_dat, price, sales_channel_id, *tie_cols).

    An aggregate (``max_by`` on a struct) rather than a window: Spark combines
    it map-side, so a customer with very many purchases is never one task's
    whole input.
    """
    order = F.struct("t_dat", "price", "sales_channel_id", *tie_cols)
    rec = F.max_by(F.struct("price", "sales_channel_id", "t_dat"), order)
    return (tx.groupBy("article_id", "customer_id").agg(rec.alias("_r"))
              .select("article_id", "customer_id", "_r.price", "_r.sales_channel_id", "_r.t_dat"))


def join_purchases(purchases: DataFrame, articles: DataFrame, customers: DataFrame) -> DataFrame:
    """Purchases x articles x customers (inner), ``a.*, c.*, price, channel, t_dat``.

    No hint: AQE turns a side into a broadcast only when its measured size is
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise the
    joins stay sort-merge and skew splitting applies. Customers come first: fewer
    columns then travel with every purchase to the second join, and purchases that
    lie by customer already (a semi-join on it) are not moved for the first.
    """
    t = purchases.alias("t")
    a = articles.alias("a")
    c = customers.alias("c")
    j = (t.join(c, F.col("c.customer_id") == F.col("t.customer_id"))
          .join(a, F.col("a.article_id") == F.col("t.article_id")))
    return j.select("a.*", "c.*", "t.price", "t.sales_channel_id", "t.t_dat")


def frequent_customers(joined: DataFrame, cut: str = "2020-09-08", min_interactions: int = 5,
                       customer_col: str = "customer_id", counted: DataFrame | None = None) -> DataFrame:
    """F01+D01+J02: keep all rows of customers with >= min purchases before ``cut``.

    The count is a partial aggregate; the join back is a semi-join (the
    aggregated side is unique per customer, so it equals the reference's inner join).
    ``counted`` holds the purchases to count where they are not the rows to keep: rows
    can then be kept before wide joins that are only needed to count them.
    """
    t_cut = datetime.strptime(cut, "%Y-%m-%d")
    freq = ((joined if counted is None else counted).filter(F.col("t_dat") < F.lit(t_cut))
                  .groupBy(customer_col).agg(F.count(F.lit(1)).alias("user_interactions"))
                  .filter(F.col("user_interactions") >= min_interactions))
    return joined.join(freq.select(customer_col), customer_col, "left_semi")


def customer_interactions(joined: DataFrame, cut: str, min_interactions: int = 5) -> DataFrame:
    """D01 alone: ``COUNT(*) .. GROUP BY customer HAVING count >= min``."""
    t_cut = datetime.strptime(cut, "%Y-%m-%d")
    return (joined.filter(F.col("t_dat") < F.lit(t_cut))
                  .groupBy("customer_id").agg(F.count(F.lit(1)).alias("user_interactions"))
                  .filter(F.col("user_interactions") >= min_interactions))


def span_counts(tx: DataFrame, start: str, end_dates: list[str], count_col: str = "customer_id") -> DataFrame:
    """Non-null ``count(col)`` for each closed span [start, end] of
    real dates, all spans from one scan (``count_if`` per end date).

    Dates compare as timestamps, not text ('2018-9-22' would sort after
    '2018-12-31' as text). An end date covers its whole day.
    """
    t0 = datetime.strptime(start, "%Y-%m-%d")
    aggs = []
    for d in end_dates:
        t1 = datetime.strptime(d, "%Y-%m-%d") + timedelta(days=1)
        cond = (F.col("t_dat") >= F.lit(t0)) & (F.col("t_dat") < F.lit(t1)) & F.col(count_col).isNotNull()
        aggs.append(F.count_if(cond).alias(f"n_{d.replace('-', '_')}"))
    wide = tx.agg(*aggs)
    # one row per end date
    stack = ", ".join(f"'{d}', n_{d.replace('-', '_')}" for d in end_dates)
    return wide.selectExpr(f"stack({len(end_dates)}, {stack}) as (end_date, n_rows)")
