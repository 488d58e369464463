"""Source plans: tolerant CSV, sampling on read, header clean-up, row ids,
parquet and glob scans, annotation JSON, file listing, feature rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.operators import sampling
from quiver.plans.registry import plan
from quiver.plans.sqlparts import BOXES, IMAGES, with_
from quiver.session import shared_path
from quiver.sources import files
from quiver.sources.tables import annotation_boxes, annotation_images, read_glob, read_table

CONV_HEADER = "conv_id,turn,role,text"


def _conversation_csv(spark, sf) -> str:
    """Conversations as raw CSV lines with unquoted text: a comma inside a turn
    gives the line too many fields, exactly the malformed input A01 skips."""
    c = read_table(spark, sf, "conversations")
    line = F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role",
                       F.regexp_replace("text", r"[\r\n]+", " "))
    path = shared_path(spark, "conversations-csv")
    c.select(line.alias("value")).write.text(path)
    return path


_CONV_SQL = """
SELECT conv_id, turn, role, nullif(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '') AS text
FROM conversations WHERE text NOT LIKE '%,%'"""


@plan("csv_tolerant", _CONV_SQL)
def q_csv_tolerant(spark, sf):
    """Tolerant CSV read of raw conversation lines: too many fields -> skipped."""
    path = _conversation_csv(spark, sf)
    return files.read_csv_tolerant(spark, path, CONV_HEADER, types={"conv_id": "bigint", "turn": "bigint"})


@plan("sample_on_read")
def q_sample_on_read(spark, sf):
    """The tolerant read followed by a 25 % Bernoulli row sample (seeded)."""
    path = _conversation_csv(spark, sf)
    return sampling.bernoulli_sample(files.read_csv_tolerant(spark, path, CONV_HEADER), 25, seed=42)


@plan("clean_header", "SELECT p_partkey, p_name AS p_, p_brand, p_type, p_size, p_retailprice FROM part")
def q_clean_header(spark, sf):
    """Column names without '\"', 'name' and blanks."""
    return files.clean_header(read_table(spark, sf, "part"))


@plan("row_id", """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_id, event_id, event_type FROM events""")
def q_row_id(spark, sf):
    """Dense 0-based row id in file order (the events file is written in id order)."""
    return files.row_ids(read_table(spark, sf, "events")).select("row_id", "event_id", "event_type")


@plan("scan_parquet", "SELECT * FROM orders")
def q_scan_parquet(spark, sf):
    """A parquet table scanned as a relation."""
    return read_table(spark, sf, "orders")


@plan("scan_glob", "SELECT * FROM lineitem")
def q_scan_glob(spark, sf):
    """Every parquet file matching a glob read as one relation."""
    return read_glob(spark, f"{sf.rstrip('/')}/lineite*.parquet")


@plan("annotations_json", with_(IMAGES, BOXES) + """,
b AS (SELECT image_key, count(*) AS n_boxes, string_agg(label, '>' ORDER BY box_pos, x, y, w, h, label) AS labels,
             round(sum(x + y + w + h), 6) AS total FROM boxes GROUP BY image_key)
SELECT i.name, i.target, b.n_boxes, b.labels, b.total, i.leading_hand, i.user_id FROM images i JOIN b ON b.image_key = i.image_key""")
def q_annotations_json(spark, sf):
    """Per-class annotation JSON (written from the annotation tables) read
    back as one row per image with name, class, its boxes' number, labels and sum."""
    path = shared_path(spark, "annotations-json")
    files.write_annotation_json(annotation_boxes(spark, sf), annotation_images(spark, sf), path)
    total = F.aggregate(F.flatten("bboxes"), F.lit(0.0), lambda a, v: a + v)
    return files.read_annotation_json(spark, path).select(
        "name", "target", F.size("bboxes").cast("long").alias("n_boxes"), F.array_join("labels", ">").alias("labels"),
        F.round(total, 6).alias("total"), "leading_hand", "user_id")


@plan("annotation_objects", with_(IMAGES, BOXES) + """,
b AS (SELECT image_key, count(*) AS n_boxes, sum(w) AS width,
             string_agg(label, '>' ORDER BY box_pos, x, y, w, h, label) AS labels FROM boxes GROUP BY image_key)
SELECT i.name, i.target, b.n_boxes, round(b.width, 6) AS width, b.labels, i.leading_hand, i.user_id
FROM images i JOIN b ON b.image_key = i.image_key""")
def q_annotation_objects(spark, sf):
    """One large JSON object per class, read back in byte ranges, one row per image."""
    path = shared_path(spark, "annotation-objects")
    files.write_annotation_objects(annotation_boxes(spark, sf), annotation_images(spark, sf), path)
    a = files.read_annotation_json(spark, path, whole_file=True)
    width = F.aggregate(F.transform("bboxes", lambda b: b[2]), F.lit(0.0), lambda x, y: x + y)
    return a.select("name", "target", F.size("bboxes").cast("long").alias("n_boxes"), F.round(width, 6).alias("width"),
                    F.array_join("labels", ">").alias("labels"), "leading_hand", "user_id")


@plan("csv_multiline", """
SELECT conv_id, turn, role, role || chr(10) || coalesce(text, '') AS text FROM conversations""")
def q_csv_multiline(spark, sf):
    """CSV with line ends, commas and quotes inside quoted fields, read in byte ranges."""
    c = read_table(spark, sf, "conversations")
    text = F.concat(F.col("role"), F.lit("\n"), F.coalesce("text", F.lit("")))
    quoted = F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))
    path = shared_path(spark, "multiline-csv")
    c.select(F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", quoted).alias("value")).write.text(path)
    return files.read_csv_tolerant(spark, path, CONV_HEADER, types={"conv_id": "bigint", "turn": "bigint"}, multi_line=True)


@plan("feature_rows", """
SELECT len(embedding) AS n_features, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total, CAST(label AS DOUBLE) AS label
FROM embeddings""")
def q_feature_rows(spark, sf):
    """Item arrays as ML feature vectors with a double label, read back as length and sum."""
    from pyspark.ml.functions import vector_to_array

    rows = files.feature_rows(read_table(spark, sf, "embeddings"), "embedding", "label")
    v = vector_to_array("features")
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    return rows.select(F.size(v).cast("long").alias("n_features"), F.round(total, 6).alias("total"), "label")
