"""Readers for the parquet tables and the column mappings onto them.

The adapters below only give the driver tables the schema each job expects
(renames and type changes). They do none of the operators' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table (A05/A06); Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Parquet glob scan (A07): every file matching the pattern is one relation."""
    return spark.read.parquet(pattern)


# --- P1: raw playlists (row_id, user_id, artist, track, playlist) from events ---
def raw_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    track = F.regexp_extract("props", r"[0-9]+", 0)
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").cast("string").alias("user_id"),
        (track.cast("int") % 10).cast("string").alias("artist"),
        track.alias("track"),
        F.col("event_type").alias("playlist"),
    )


# --- P2: fashion-purchase raw tables from part / customer / lineitem+orders ---
def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    brand_no = F.regexp_extract("p_brand", r"[0-9]+", 0).cast("int")
    return p.select(
        F.col("p_partkey").alias("article_id"),
        F.col("p_size").alias("product_code"),
        brand_no.alias("product_type_no"),
        F.col("p_type").alias("product_group_name"),
        (F.col("p_size") % 10).alias("graphical_appearance_no"),
        (F.col("p_size") % 7).alias("colour_group_code"),
        (F.col("p_size") % 5).alias("perceived_colour_value_id"),
        (F.col("p_size") % 3).alias("perceived_colour_master_id"),
        (brand_no % 10).alias("department_no"),
        F.col("p_brand").alias("index_code"),
        (brand_no % 4).alias("index_group_no"),
        (F.col("p_size") % 11).alias("section_no"),
        (F.col("p_size") % 13).alias("garment_group_no"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_nationkey").cast("string").alias("Active"),
        F.col("c_mktsegment").alias("FN"),
        (F.col("c_acctbal") / 100).cast("string").alias("age"),
        F.col("c_mktsegment").alias("club_member_status"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        (F.col("c_nationkey") % 3).cast("string").alias("fashion_news_frequency"),
        F.col("c_nationkey").cast("string").alias("postal_code"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases: article = part, customer = order's customer, day = ship date.

    ``l_orderkey`` and ``l_suppkey`` ride along only as tie columns for a total order.
    """
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("article_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").alias("sales_channel_id"),
        F.col("l_shipdate").alias("t_dat"),
        F.col("l_orderkey").alias("tie_order"),
        F.col("l_suppkey").alias("tie_supp"),
    )


# --- P3: reviews (review, labels, score) from documents + labels ---
def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", "lang")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    # stand-in model score in (0, 1): a fixed monotone map of the text length
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("text").alias("review"), F.col("quality").alias("labels"),
        F.col("n_chars").alias("score_raw"), score.alias("score"), "lang")


# --- P1 names: a document's title (its text up to the first period or line end) names a track ---
def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.regexp_extract("text", r"^[^.\n]*", 0).alias("title"))


# --- P1 vectors ---
def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    # item key in the playlists' track-id format: "<vec_id % 10>|||<vec_id>"
    item_id = F.concat_ws("", (F.col("vec_id") % 10).cast("string"), F.lit("|||"),
                          F.col("vec_id").cast("string"))
    return e.select(item_id.alias("item_id"),
                    F.col("embedding").cast("array<double>").alias("vec"),
                    F.col("label"))


# --- P4 annotations: order = image (class folder = priority), line item = box ---
def annotation_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per annotated image: key, file name, class folder, user, leading hand."""
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        key.alias("image_key"),
        F.concat(key, F.lit(".jpg")).alias("name"),
        F.col("o_orderpriority").alias("target"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", "right").otherwise("left").alias("leading_hand"),
    )


def annotation_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per box: image key, position, relative xywh, label, detector score."""
    li = read_table(spark, sf_dir, "lineitem")
    label = (F.when(F.col("l_returnflag") == "N", "no_gesture")
              .when(F.col("l_returnflag") == "A", "call").otherwise("rock"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("image_key"),
        F.col("l_linenumber").alias("box_pos"),
        F.col("l_discount").alias("x"),
        F.col("l_tax").alias("y"),
        (F.col("l_quantity") / 100).alias("w"),
        ((F.col("l_discount") + F.col("l_tax")) / 2).alias("h"),
        label.alias("label"),
        (F.col("l_discount") * 10).alias("score"),
    )


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File listing stand-in: one file name per image key present in lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".jpg")).alias("name")).distinct()


# --- P5 runs: flow = user, run = event, successful = not an error ---
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("flow"),
        F.col("event_id").alias("run_id"),
        (F.col("event_type") != "error").alias("successful"),
        F.array(F.col("event_type")).alias("tags"),
        F.col("value").alias("metric"),
        F.col("ts").alias("created_at"),
    )


# --- P5 run results: order = run (successful when status F), line item = result row ---
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("flow"),
                    (F.col("o_orderstatus") == "F").alias("successful"), F.col("o_orderdate").alias("created_at"))


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("row_idx"),
                     F.col("l_returnflag").alias("model"), (F.col("l_quantity") / 50).alias("accuracy"),
                     (F.col("l_tax") * 10).alias("test_loss"))
