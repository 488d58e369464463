"""Feature-encoding plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions.common import arr_text, r6
from quiver.operators import features
from quiver.plans.purchases import split_table, tx
from quiver.plans.registry import plan
from quiver.plans.sqlparts import SPLIT, STAGED_CUSTOMERS, STAGED_TX, with_
from quiver.plans.purchases import customers


def codes_sql(name: str, src: str, col: str, where: str = "") -> str:
    cond = f"{col} IS NOT NULL" + (f" AND {where}" if where else "")
    return (f"{name} AS (SELECT {col} AS _value, row_number() OVER (ORDER BY COUNT(*) DESC, {col}) AS code "
            f"FROM {src} WHERE {cond} GROUP BY {col})")


@plan("categorify", with_(STAGED_TX, codes_sql("codes", "tx", "article_id")) +
      " SELECT _value AS article_id, code FROM codes")
def q_categorify(spark, sf):
    """Article code by purchase frequency (count desc, id asc), from 1."""
    cat = features.fit_categories(tx(spark, sf), "article_id")
    return cat.mapping.select(F.col("_value").alias("article_id"), "code")


_AGE_SQL = with_(STAGED_CUSTOMERS, """
b AS (SELECT customer_id, coalesce(age, 0.0) AS age,
             CASE WHEN coalesce(age, 0.0) < 0 THEN 0 WHEN coalesce(age, 0.0) >= 95 THEN 20
                  ELSE floor(coalesce(age, 0.0) / 5)::INTEGER + 1 END AS age_bucket FROM customers)""",
                   codes_sql("codes", "b", "age_bucket")) + """
SELECT customer_id, round(age, 6) AS age, age_bucket, codes.code AS age_bucket_code
FROM b LEFT JOIN codes ON b.age_bucket = codes._value"""


@plan("age_bucket", _AGE_SQL)
def q_age_bucket(spark, sf):
    """E02+E03+E01: age filled with 0, bucketised on 0..95 step 5, then coded."""
    b = features.age_buckets(customers(spark, sf))
    out = features.fit_categories(b, "age_bucket").transform(b)
    return out.select("customer_id", r6("age").alias("age"), "age_bucket", "age_bucket_code")


@plan("date_parts", with_(STAGED_TX, """
d AS (SELECT article_id, customer_id, t_dat, month(t_dat) AS purchase_month,
             year(t_dat) AS purchase_year FROM tx)""",
                         codes_sql("mc", "d", "purchase_month"),
                         codes_sql("yc", "d", "purchase_year")) + """
SELECT article_id, customer_id, t_dat, purchase_month, purchase_year,
       mc.code AS purchase_month_code, yc.code AS purchase_year_code
FROM d LEFT JOIN mc ON d.purchase_month = mc._value LEFT JOIN yc ON d.purchase_year = yc._value""")
def q_date_parts(spark, sf):
    """Purchase month and year, each coded by frequency."""
    d = features.date_parts(tx(spark, sf)).select("article_id", "customer_id", "t_dat",
                                                  "purchase_month", "purchase_year")
    d = features.categorify(d, ["purchase_month", "purchase_year"])
    return d


_AVG_PRICE_CTE = """
means AS (SELECT article_id, avg(price::DOUBLE) AS m FROM split_rows WHERE split = 'train'
          GROUP BY article_id),
wm AS (SELECT s.*, coalesce(means.m, 0.0) AS avg_price0
       FROM split_rows s LEFT JOIN means ON s.article_id = means.article_id),
st AS (SELECT avg(avg_price0) AS mu, stddev_samp(avg_price0) AS sd FROM wm WHERE split = 'train'),
z AS (SELECT wm.*, CASE WHEN coalesce(sd, 0) = 0 THEN 0.0 ELSE (avg_price0 - mu) / sd END AS avg_price
      FROM wm, st)"""


@plan("item_avg_price", with_(SPLIT, _AVG_PRICE_CTE) + """
SELECT article_id, customer_id, t_dat, split, round(avg_price, 6) AS avg_price FROM z""")
def q_item_avg_price(spark, sf):
    """Item mean price (fit on train) on every row, fill 0, z-score."""
    s = split_table(spark, sf, ["article_id", "customer_id", "t_dat", "split", "price"])
    out = features.item_avg_price(s, fit_on=s.filter(F.col("split") == "train"))
    return out.select("article_id", "customer_id", "t_dat", "split", r6("avg_price").alias("avg_price"))


ENC_COLS = ["customer_id", "article_id", "age_bucket", "purchase_month", "purchase_year",
            "product_group_name", "club_member_status"]

_ENC_BASE = """
base AS (SELECT z.*,
   CASE WHEN coalesce(age, 0.0) < 0 THEN 0 WHEN coalesce(age, 0.0) >= 95 THEN 20
        ELSE floor(coalesce(age, 0.0) / 5)::INTEGER + 1 END AS age_bucket,
   month(t_dat) AS purchase_month, year(t_dat) AS purchase_year FROM z)"""

_ENC_SQL = (with_(SPLIT, _AVG_PRICE_CTE, _ENC_BASE,
                  *[codes_sql(f"c_{c}", "base", c, "split = 'train'") for c in ENC_COLS]) +
            " SELECT base.split, base.article_id, base.customer_id, base.t_dat, " +
            ", ".join(f"coalesce(c_{c}.code, 0) AS {c}_code" for c in ENC_COLS) +
            ", round(base.avg_price, 6) AS avg_price FROM base " +
            " ".join(f"LEFT JOIN c_{c} ON base.{c} = c_{c}._value" for c in ENC_COLS))


def _encoded(spark, sf):
    cols = ["article_id", "customer_id", "t_dat", "split", "price", "age", "product_group_name",
            "club_member_status"]
    return features.encode_splits(split_table(spark, sf, cols), fit_on_all=False)


@plan("encode_splits", _ENC_SQL)
def q_encode_splits(spark, sf):
    """Encoders fitted on the train split, applied to train/valid/test."""
    e = _encoded(spark, sf).frame
    return e.select("split", "article_id", "customer_id", "t_dat",
                    *[f"{c}_code" for c in ENC_COLS], r6("avg_price").alias("avg_price"))


_ROLE_ROWS = [("customer_id_code", ["user_id", "user"]), ("article_id_code", ["item_id", "item"]),
              ("age_bucket_code", ["user"]), ("purchase_month_code", ["user"]),
              ("purchase_year_code", ["user"]), ("product_group_name_code", ["item"]),
              ("club_member_status_code", ["user"])]


def _role_sql():
    enc = _ENC_SQL[:_ENC_SQL.rindex(" SELECT base.split")]
    body = ("enc AS (SELECT " + ", ".join(f"coalesce(c_{c}.code, 0) AS {c}_code" for c in ENC_COLS) +
            " FROM base " + " ".join(f"LEFT JOIN c_{c} ON base.{c} = c_{c}._value" for c in ENC_COLS) + ")")
    parts = []
    for col, tags in _ROLE_ROWS:
        for t in tags:
            parts.append(f"SELECT '{t}' AS role, '{col}' AS column_name, max({col}) + 1 AS cardinality FROM enc")
    return enc + ", " + body + " " + " UNION ALL ".join(parts)


@plan("role_columns", _role_sql())
def q_role_columns(spark, sf):
    """User / item / id roles of the encoded columns with their cardinality."""
    return features.role_cardinalities(_encoded(spark, sf).frame)


@plan("decode_ids", with_(SPLIT, codes_sql("cu", "split_rows", "customer_id", "split = 'train'"),
                          codes_sql("ca", "split_rows", "article_id", "split = 'train'")) + """,
t AS (SELECT s.customer_id, s.article_id, s.t_dat, coalesce(cu.code, 0) AS user_code,
             coalesce(ca.code, 0) AS item_code
      FROM split_rows s LEFT JOIN cu ON s.customer_id = cu._value
      LEFT JOIN ca ON s.article_id = ca._value WHERE s.split = 'test'),
lists AS (SELECT user_code, list(coalesce(CAST(ca2._value AS VARCHAR), '?')
                            ORDER BY t.t_dat, t.item_code, t.article_id) AS items
          FROM t LEFT JOIN ca ca2 ON t.item_code = ca2.code GROUP BY user_code)
SELECT coalesce(cu2._value, '?') AS customer_id, array_to_string(items, '>') AS items
FROM lists LEFT JOIN cu cu2 ON lists.user_code = cu2.code""")
def q_decode_ids(spark, sf):
    """Coded test purchases per user code -> user id and every list element decoded."""
    s = split_table(spark, sf, ["article_id", "customer_id", "t_dat", "split"])
    train = s.filter(F.col("split") == "train")
    cats = features.fit_many(train, ["customer_id", "article_id"])
    cu, ca = cats["customer_id"], cats["article_id"]
    t = ca.transform(cu.transform(s.filter(F.col("split") == "test"), "user_code"), "item_code")
    lists = (t.groupBy("user_code")
              .agg(F.sort_array(F.collect_list(F.struct("t_dat", "item_code", "article_id"))).alias("_l"))
              .select("user_code", F.transform("_l", lambda e: e["item_code"]).alias("item_codes")))
    from quiver.operators.recs import decode_list
    dec = decode_list(lists, "item_codes", ca.mapping, "items")
    dec = cu.decode(dec, "user_code", "customer_id")
    return dec.select(F.coalesce("customer_id", F.lit("?")).alias("customer_id"),
                      arr_text(F.transform("items", lambda x: F.coalesce(x.cast("string"), F.lit("?"))))
                      .alias("items"))
