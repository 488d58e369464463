"""P2 purchase plans: staging, dedup, joins, frequent buyers, splits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quiver.functions.common import r6
from quiver.operators import profile, sampling, sinks, staging
from quiver.operators.ranking import pin
from quiver.plans.registry import plan
from quiver.plans.sqlparts import (DEDUP, FILTERED, JOINED, RAW_CUSTOMERS, SPLIT, STAGED_ARTICLES,
                                   STAGED_CUSTOMERS, STAGED_TX, with_)
from quiver.sources.tables import raw_articles, raw_customers, raw_transactions

TRAIN_END = "2001-01-01"
VALID_END = "2001-07-01"

TRAINING_COLS = staging.ARTICLE_COLS + staging.CUSTOMER_COLS + staging.TX_COLS
_SQL_TRAINING = ", ".join(
    c if c not in ("price", "age") else f"round({c}::DOUBLE, 6) AS {c}" for c in TRAINING_COLS)


def _training_out(df):
    return df.select(*[r6(c).alias(c) if c in ("price", "age") else F.col(c) for c in TRAINING_COLS])


def tx(spark, sf):
    return staging.stage_transactions(raw_transactions(spark, sf), keep=("tie_order", "tie_supp"))


def articles(spark, sf):
    return staging.stage_articles(raw_articles(spark, sf))


def customers(spark, sf):
    return staging.stage_customers(raw_customers(spark, sf))


def joined(spark, sf):
    return staging.join_purchases(staging.dedup_transactions(tx(spark, sf)),
                                  articles(spark, sf), customers(spark, sf))


def filtered(spark, sf, written: bool = False):
    """Purchases with article and customer columns of the frequent buyers. Who stays is known
    before those columns are joined on. The day is one of the dedup keys, so the purchases
    before and from the cut on are deduplicated apart: the earlier ones, counted and kept,
    are then one shuffle that both branches read. ``written`` writes the deduplicated purchases
    once in between, so that the shuffles before need not stay until the last join ends."""
    t, a, c = tx(spark, sf), articles(spark, sf), customers(spark, sf)
    cut = F.lit(datetime.strptime(TRAIN_END, "%Y-%m-%d"))
    once, each = (sinks.write_and_reload(spark, staging.dedup_transactions(t), "purchases"), lambda x: x) if written else (t, staging.dedup_transactions)
    early = each(once.filter(F.col("t_dat") < cut))
    late = each(once.filter(F.col("t_dat").isNull() | (F.col("t_dat") >= cut)))
    kept = staging.frequent_customers(early.unionByName(late), TRAIN_END, 5, counted=staging.join_purchases(early, a, c))
    return staging.join_purchases(kept, a, c)


def split_rows(spark, sf, written: bool = False):
    return sampling.time_split(filtered(spark, sf, written), "t_dat", TRAIN_END, VALID_END)


def split_table(spark, sf, cols: list[str] | None = None, written: bool = False):
    """The split training frame written to the shared checkpoint folder, for
    plans that read it several times (fits, statistics, transforms): the
    reference also materialises this frame as a file before modelling.
    ``cols`` prunes it first, so only the needed columns are computed; ``written`` as in ``filtered``."""
    s = split_rows(spark, sf, written)
    if cols:
        s = s.select(*cols)
    return sinks.write_and_reload(spark, s, "split-table")


@plan("stage_articles", with_(STAGED_ARTICLES) + " SELECT * FROM articles")
def q_stage_articles(spark, sf):
    """13 article columns, strict casts."""
    return articles(spark, sf)


@plan("stage_customers", with_(STAGED_CUSTOMERS) + """
SELECT round(active, 6) AS active, round(fn, 6) AS fn, round(age, 6) AS age, club_member_status,
       customer_id, fashion_news_frequency, postal_code FROM customers""")
def q_stage_customers(spark, sf):
    """coalesce(try_cast(x as double), 0.0) on active/fn/age."""
    c = customers(spark, sf)
    return c.select(*[r6(x).alias(x) if x in ("active", "fn", "age") else x for x in c.columns])


@plan("stage_transactions", with_(STAGED_TX) + """
SELECT article_id, customer_id, round(price::DOUBLE, 6) AS price, sales_channel_id, t_dat FROM tx""")
def q_stage_transactions(spark, sf):
    """::INT / ::VARCHAR / ::FLOAT / ::TIMESTAMP casts of the purchase fact."""
    return tx(spark, sf).select("article_id", "customer_id", r6("price").alias("price"),
                                "sales_channel_id", "t_dat")


@plan("lowercase_cols", with_(RAW_CUSTOMERS) + """
SELECT Active AS active, FN AS fn, age, club_member_status, customer_id,
       fashion_news_frequency, postal_code FROM raw_customers""")
def q_lowercase_cols(spark, sf):
    """Lower-case every column name."""
    return staging.lowercase_columns(raw_customers(spark, sf))


@plan("dedup_transactions", with_(DEDUP) + """
SELECT article_id, customer_id, round(price::DOUBLE, 6) AS price, sales_channel_id, t_dat FROM dedup""")
def q_dedup(spark, sf):
    """D07+W01: GROUP BY all columns + last_value over the default frame (literal model)."""
    d = staging.dedup_transactions(tx(spark, sf))
    return d.select("article_id", "customer_id", r6("price").alias("price"), "sales_channel_id", "t_dat")


@plan("last_purchase", with_(STAGED_TX) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY article_id, customer_id
                                   ORDER BY t_dat DESC, price DESC, sales_channel_id DESC,
                                            tie_order DESC, tie_supp DESC) AS rn FROM tx)
SELECT article_id, customer_id, round(price::DOUBLE, 6) AS price, sales_channel_id, t_dat
FROM r WHERE rn = 1""")
def q_last_purchase(spark, sf):
    """Last purchase per (article, customer) with a total tie order."""
    d = staging.last_purchase(tx(spark, sf), tie_cols=("tie_order", "tie_supp"))
    return d.select("article_id", "customer_id", r6("price").alias("price"), "sales_channel_id", "t_dat")


@plan("join_purchases", with_(JOINED) + f" SELECT {_SQL_TRAINING} FROM joined")
def q_join_purchases(spark, sf):
    """Dedup purchases x articles x customers."""
    return _training_out(joined(spark, sf))


@plan("customer_interactions", with_(JOINED) + """
SELECT customer_id, COUNT(*) AS user_interactions FROM joined
WHERE t_dat < TIMESTAMP '2001-01-01' GROUP BY customer_id HAVING COUNT(*) >= 5""")
def q_customer_interactions(spark, sf):
    """Purchases per customer before the cut, HAVING >= 5."""
    return staging.customer_interactions(joined(spark, sf), TRAIN_END, 5)


@plan("frequent_customers", with_(FILTERED) + f" SELECT {_SQL_TRAINING} FROM filtered")
def q_frequent_customers(spark, sf):
    """F01+D01+J02: all rows of customers with >= 5 purchases before the cut."""
    return _training_out(filtered(spark, sf))


@plan("time_split", with_(SPLIT) + f" SELECT {_SQL_TRAINING}, split FROM split_rows")
def q_time_split(spark, sf):
    """half-open train / valid / test split by purchase time."""
    s = split_rows(spark, sf)
    return s.select(*[r6(c).alias(c) if c in ("price", "age") else F.col(c) for c in TRAINING_COLS],
                    "split")


@plan("ordered_training", with_(FILTERED) + f" SELECT {_SQL_TRAINING} FROM filtered ORDER BY t_dat")
def q_ordered_training(spark, sf):
    """The 23-column training frame, ordered by time only at the sink."""
    return _training_out(filtered(spark, sf)).orderBy("t_dat", "customer_id", "article_id")


@plan("span_counts", with_(STAGED_TX) + """
SELECT '1995-01-31' AS end_date, count(customer_id) FILTER (
         WHERE t_dat >= TIMESTAMP '1995-01-01' AND t_dat < TIMESTAMP '1995-02-01') AS n_rows FROM tx
UNION ALL
SELECT '1995-12-31', count(customer_id) FILTER (
         WHERE t_dat >= TIMESTAMP '1995-01-01' AND t_dat < TIMESTAMP '1996-01-01') FROM tx
UNION ALL
SELECT '1998-12-31', count(customer_id) FILTER (
         WHERE t_dat >= TIMESTAMP '1995-01-01' AND t_dat < TIMESTAMP '1999-01-01') FROM tx""")
def q_span_counts(spark, sf):
    """Non-null counts over three date spans from one scan."""
    return staging.span_counts(tx(spark, sf), "1995-01-01", ["1995-01-31", "1995-12-31", "1998-12-31"])


@plan("item_metadata", with_(FILTERED) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY t_dat DESC, customer_id DESC,
                                   price DESC, sales_channel_id DESC) AS rn FROM filtered)
SELECT article_id, customer_id, round(price::DOUBLE, 6) AS price, sales_channel_id, t_dat,
       product_group_name FROM r WHERE rn = 1""")
def q_item_metadata(spark, sf):
    """Last-write-wins record per article in time order."""
    cols = ["article_id", "customer_id", "price", "sales_channel_id", "t_dat", "product_group_name"]
    m = profile.last_record_per_key(filtered(spark, sf).select(*cols), "article_id",
                                    ["t_dat", "customer_id", "price", "sales_channel_id"])
    return m.select("article_id", "customer_id", r6("price").alias("price"), "sales_channel_id",
                    "t_dat", "product_group_name")


@plan("union_splits", with_(SPLIT) + " SELECT article_id, customer_id, t_dat, split FROM split_rows")
def q_union_splits(spark, sf):
    """The three split frames concatenated back by column name (bag union)."""
    s = pin(split_rows(spark, sf).select("article_id", "customer_id", "t_dat", "split"))  # read three times
    parts = [s.filter(F.col("split") == lab) for lab in ("train", "valid", "test")]
    parts[1] = parts[1].select("split", "t_dat", "customer_id", "article_id")  # other column order
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@plan("write_splits", with_(SPLIT) + " SELECT * FROM split_rows")
def q_write_splits(spark, sf):
    """Split training frame written as parquet partitioned by split, read back."""
    s = split_rows(spark, sf)
    return sinks.write_and_reload(spark, s, "splits", partition_col="split")
