"""Recommendation plans: popularity recommendations per test shopper,
decoding, recall/NDCG, key-value records, lookups and list extension."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions.common import arr_text, r6
from quiver.operators import features, metrics, profile, recs, sinks
from quiver.plans.features import codes_sql
from quiver.plans.playlists import _sequences
from quiver.plans.purchases import split_table
from quiver.plans.registry import plan
from quiver.plans.sqlparts import SEQUENCES, SPLIT, VECTORS, with_
from quiver.sources.tables import item_vectors, read_table

K = 10

_RECS_SQL = with_(SPLIT, codes_sql("cu", "split_rows", "customer_id"), codes_sql("ca", "split_rows", "article_id")) + f""",
pop AS (SELECT ca.code, count(*) AS n FROM split_rows s JOIN ca ON s.article_id = ca._value
        WHERE s.split = 'train' GROUP BY ca.code ORDER BY n DESC, ca.code LIMIT {K}),
poplist AS (SELECT list(CAST(ca._value AS VARCHAR) ORDER BY pop.n DESC, pop.code) AS items
            FROM pop JOIN ca ON pop.code = ca.code),
test AS (SELECT s.customer_id, s.article_id, s.t_dat,
                row_number() OVER (PARTITION BY s.customer_id ORDER BY s.t_dat, s.article_id, s.price,
                                   s.sales_channel_id) AS rn
         FROM split_rows s WHERE s.split = 'test'),
firsts AS (SELECT * FROM test WHERE rn = 1),
user_recs AS (SELECT f.customer_id, (SELECT items FROM poplist) AS items, CAST(f.article_id AS VARCHAR) AS target
              FROM firsts f)"""


def user_recs(spark, sf, k: int = K):
    """Codes fitted on all splits (the reference's way); popularity top-k in
    code space; one prediction per test row; first record per shopper; user,
    items and target decoded back to ids."""
    s = split_table(spark, sf, ["article_id", "customer_id", "t_dat", "split", "price", "sales_channel_id"])
    cats = features.fit_many(s, ["customer_id", "article_id"])
    cu, ca = cats["customer_id"], cats["article_id"]
    coded = ca.transform(cu.transform(s, "user_code"), "item_code")
    pop = recs.popularity_topk(coded.filter(F.col("split") == "train"), "item_code", k)
    test = coded.filter(F.col("split") == "test").select("user_code", "item_code", "t_dat", "article_id", "price",
                                                        "sales_channel_id")
    first = recs.first_per_user(test, "user_code", ["t_dat", "article_id", "price", "sales_channel_id"])
    # the list is the same for everyone: its k codes are decoded once, as a scalar subquery
    one = recs.decode_list(pop.select(F.lit(1).alias("_one"), F.col("items").alias("codes")), "codes", ca.mapping, "items")
    items = one.select("items").scalar()
    pred = first.select("user_code", F.col("item_code").alias("target_code"), items.alias("items"))
    dec = cu.decode(pred, "user_code", "customer_id")
    dec = ca.decode(dec, "target_code", "target")
    return dec.select("customer_id", F.col("items").cast("array<string>").alias("items"),
                      F.col("target").cast("string").alias("target"))


@plan("user_recs", _RECS_SQL + " SELECT customer_id, array_to_string(items, '>') AS items, target FROM user_recs")
def q_user_recs(spark, sf):
    """Top-10 popular articles for every test shopper, decoded."""
    r = user_recs(spark, sf)
    return r.select("customer_id", arr_text("items").alias("items"), "target")


@plan("first_prediction", _RECS_SQL + " SELECT customer_id, target FROM user_recs")
def q_first_prediction(spark, sf):
    """First-write-wins record per test shopper (earliest purchase, ties by article)."""
    return user_recs(spark, sf).select("customer_id", "target")


@plan("recall_ndcg", _RECS_SQL + """,
rk AS (SELECT list_position(items[1:10], target) AS r FROM user_recs)
SELECT round(avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END), 6) AS recall_at_10,
       round(avg(CASE WHEN r > 0 THEN 1.0 / log2(r + 1) ELSE 0.0 END), 6) AS ndcg_at_10, count(*) AS n FROM rk""")
def q_recall_ndcg(spark, sf):
    """recall@10 and NDCG@10 of the recommendations against each shopper's target."""
    m = metrics.recall_ndcg(user_recs(spark, sf), "items", "target", K)
    return m.select(r6("recall_at_10").alias("recall_at_10"), r6("ndcg_at_10").alias("ndcg_at_10"), "n")


@plan("recs_kv", _RECS_SQL + """
SELECT CAST(customer_id AS VARCHAR) AS userId,
       '{"items":' || CAST(to_json(items::VARCHAR[]) AS VARCHAR)
       || CASE WHEN target IS NULL THEN '' ELSE ',"target":' || CAST(to_json(CAST(target AS VARCHAR)) AS VARCHAR) END || '}' AS recs
FROM user_recs
UNION ALL
SELECT 'no_user', '{"items":[' || string_agg('"test_rec_' || i || '"', ',' ORDER BY i) || ']}' FROM range(10) r(i)
""")
def q_recs_kv(spark, sf):
    """Key-value records (userId, JSON recs) + the no_user default,
    written as parquet to the shared folder and read back."""
    kv = recs.kv_records(user_recs(spark, sf), "customer_id", K)
    return sinks.write_and_reload(spark, kv, "recs-kv")


@plan("recs_lookup", _RECS_SQL + """,
kv AS (SELECT customer_id AS userId, items FROM user_recs),
req AS (SELECT CAST(c_custkey AS VARCHAR) AS userId FROM customer)
SELECT req.userId, array_to_string(coalesce(kv.items, []), '>') AS items, (kv.items IS NOT NULL) AS found
FROM req LEFT JOIN kv ON coalesce(req.userId, 'no_user') = kv.userId""")
def q_recs_lookup(spark, sf):
    """Every customer id looked up in the key-value records; unknown ids
    get an empty list, a missing id the no_user record."""
    kv = recs.kv_records(user_recs(spark, sf), "customer_id", K)
    req = read_table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("userId"))
    out = recs.lookup(req, kv, "userId")
    return out.select("userId", arr_text("items").alias("items"), "found")


@plan("extend_items", with_(SEQUENCES, VECTORS) + """,
items AS (SELECT unnest(track_sequence) AS track_id FROM seqs),
top AS (SELECT track_id FROM items GROUP BY track_id ORDER BY count(*) DESC, track_id LIMIT 250),
base AS (SELECT track_id FROM top SEMI JOIN vectors v ON top.track_id = v.item_id),
cand AS (SELECT DISTINCT unnest(track_sequence) AS track_id FROM seqs WHERE contains(playlist_id, 'error'))
SELECT track_id FROM base
UNION ALL
SELECT track_id FROM cand
WHERE track_id IN (SELECT item_id FROM vectors) AND track_id NOT IN (SELECT track_id FROM base)""")
def q_extend_items(spark, sf):
    """The 250 most common tracks with vectors, extended by tracks of 'error'
    playlists that have a vector and are not already listed."""
    seqs = _sequences(spark, sf)
    vec = item_vectors(spark, sf).select(F.col("item_id").alias("track_id"))
    flat = seqs.select(F.explode("track_sequence").alias("track_id"))
    base = profile.most_common(flat, "track_id", 250).select("track_id").join(vec, "track_id", "left_semi")
    cand = seqs.filter(F.col("playlist_id").contains("error")).select(F.explode("track_sequence").alias("track_id"))
    return recs.extend_items(base, cand, vec, "track_id")
