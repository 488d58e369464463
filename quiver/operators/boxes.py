"""Annotation rows, box choice, class codes, COCO tables and detections
(A08, A12, F06, W03, W08, S18, S19, X07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiver.functions import boxes as bx
from quiver.operators.ranking import rank_by, top_n_per_group

# Gesture class lists in the two configurations' order.
CLASSIFIER_TARGETS = [
    "call", "dislike", "fist", "four", "like", "mute", "ok", "one", "palm", "peace", "rock", "stop",
    "stop_inverted", "three", "two_up", "two_up_inverted", "three2", "peace_inverted", "no_gesture",
]
CONVERTER_TARGETS = [
    "call", "dislike", "fist", "four", "like", "mute", "ok", "one", "palm", "peace_inverted", "peace",
    "rock", "stop_inverted", "stop", "three", "three2", "two_up", "two_up_inverted", "no_gesture",
]
NO_GESTURE = "no_gesture"


def label_codes(spark, targets: list[str]) -> DataFrame:
    """Class name -> position in the configured list."""
    return spark.createDataFrame([(t, i) for i, t in enumerate(targets)], "label string, code int")


def code_labels(df: DataFrame, label_col: str, targets: list[str], out_col: str = "category_id") -> DataFrame:
    """A12 applied: join the (bounded, configured) class table."""
    codes = F.broadcast(label_codes(df.sparkSession, targets).withColumnRenamed("label", label_col)
                        .withColumnRenamed("code", out_col))
    return df.join(codes, label_col, "left")


def existing_images(images: DataFrame, files: DataFrame) -> DataFrame:
    """keep annotations whose file name is in the listing (name only, any class)."""
    return images.join(files.select("name"), "name", "left_semi")


def subset_per_class(images: DataFrame, n: int, class_col: str = "target", order_col: str = "name") -> DataFrame:
    """First ``n`` files of each class in name order."""
    return top_n_per_group(images, [class_col], [order_col], n)


def with_geometry(boxes: DataFrame, width, height) -> DataFrame:
    """Absolute box, corners, area and polygon for each box row."""
    d = boxes.withColumns(bx.abs_xywh("x", "y", "w", "h", width, height))
    d = d.withColumns(bx.abs_xyxy("x", "y", "w", "h", width, height))
    return d.withColumns({"area": bx.area("abs_w", "abs_h"),
                          "segmentation": bx.polygon("abs_x", "abs_y", "abs_w", "abs_h")})


def choose_box(images: DataFrame, boxes: DataFrame, seed: int = 42, epoch: int = 0,
               p_gesture: float = 0.7) -> DataFrame:
    """Per image the last gesture box and the last no_gesture box (by position,
    then by the box itself, so repeated positions have a fixed choice);
    draw 'gesture' with probability ``p_gesture`` from md5(name, seed, epoch);
    if the drawn kind is absent, take the kind of the image's first box; flip
    the leading hand when the chosen box is no_gesture."""
    kind = F.when(F.col("label") == NO_GESTURE, "no_gesture").otherwise("gesture")
    b = boxes.withColumn("_kind", kind)
    box = F.struct("box_pos", "x", "y", "w", "h", "label")
    per = b.groupBy("image_key").agg(
        F.max(F.when(F.col("_kind") == "gesture", box)).alias("_g"),
        F.max(F.when(F.col("_kind") == "no_gesture", box)).alias("_n"),
        F.min_by("_kind", box).alias("_first"),
    )
    u = F.conv(F.substring(F.md5(F.concat_ws("|", "name", F.lit(str(seed)), F.lit(str(epoch)))), 1, 8), 16, 10) \
        .cast("double") / float(16 ** 8)
    j = images.join(per, "image_key")
    drawn = F.when(u < p_gesture, "gesture").otherwise("no_gesture")
    has = F.when(drawn == "gesture", F.col("_g").isNotNull()).otherwise(F.col("_n").isNotNull())
    choice = F.when(has, drawn).otherwise(F.col("_first"))
    j = j.withColumn("choice", choice)
    chosen = F.when(F.col("choice") == "gesture", F.col("_g")).otherwise(F.col("_n"))
    j = j.withColumn("_c", chosen)
    hand = F.when(F.col("_c.label") == NO_GESTURE,
                  F.when(F.col("leading_hand") == "left", "right").otherwise("left")).otherwise(F.col("leading_hand"))
    return j.select("image_key", "name", "choice", F.col("_c.box_pos").alias("box_pos"),
                    F.col("_c.label").alias("gesture"), hand.alias("leading_hand_class"),
                    "_c.x", "_c.y", "_c.w", "_c.h")


def coco_tables(images: DataFrame, boxes: DataFrame, targets: list[str], width: int, height: int,
                order_cols=("image_id", "box_pos")):
    """(categories, images, annotations) DataFrames.

    Image ids are the rank of the image key; annotation ids the 0-based rank
    over (image id, box position); both exact ranks without a global window."""
    spark = images.sparkSession
    cats = label_codes(spark, targets).select(F.lit("none").alias("supercategory"),
                                              F.col("label").alias("name"), F.col("code").alias("id"))
    imgs = rank_by(images.select("image_key", "name", "target"), ["image_key"], rank_col="id")
    imgs = imgs.select("image_key", F.concat_ws("/", "target", "name").alias("file_name"),
                       F.lit(height).alias("height"), F.lit(width).alias("width"),
                       (F.col("id") - 1).alias("id"))
    b = with_geometry(boxes.join(imgs.select("image_key", F.col("id").alias("image_id")), "image_key"),
                      width, height)
    b = code_labels(b, "label", targets)
    ann = rank_by(b, list(order_cols), rank_col="_r")
    ann = ann.select((F.col("_r") - 1).alias("id"), "image_id", "category_id", "abs_x", "abs_y", "abs_w",
                     "abs_h", "segmentation", F.lit(0).alias("iscrowd"), "area")
    return cats, imgs, ann


def filter_detections(boxes: DataFrame, n: int = 2, threshold: float = 0.5,
                      order_cols=("box_pos", "x", "y", "w", "h", "label", "score")) -> DataFrame:
    """The first ``n`` detections of each image (detector order) with
    score > threshold; ``pos`` is the 0-based position in that order."""
    first = top_n_per_group(boxes, ["image_key"], list(order_cols), n, rank_col="_rk")
    return (first.withColumn("pos", (F.col("_rk") - 1).cast("int"))
                 .filter(F.col("score") > threshold).drop("_rk"))
