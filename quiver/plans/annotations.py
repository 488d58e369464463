"""Gesture-annotation plans: geometry, box choice, splits, COCO, detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiver.functions import boxes as bx
from quiver.functions.common import r6
from quiver.operators import boxes, sampling
from quiver.plans.registry import plan
from quiver.plans.sqlparts import BOXES, FILES, IMAGES, with_
from quiver.sources.tables import annotation_boxes, annotation_images, image_files

W, H = 640, 480  # image size of the stand-in annotations
ABS = ("x * 640 AS ax, y * 480 AS ay, w * 640 AS aw, h * 480 AS ah, "
       "x * 640 AS x1, y * 480 AS y1, (x + w) * 640 AS x2, (y + h) * 480 AS y2")


def _geo(spark, sf):
    return boxes.with_geometry(annotation_boxes(spark, sf), W, H)


@plan("bbox_abs", with_(BOXES) + """
SELECT image_key, box_pos, round(x * 640, 6) AS abs_x, round(y * 480, 6) AS abs_y,
       round(w * 640, 6) AS abs_w, round(h * 480, 6) AS abs_h FROM boxes""")
def q_bbox_abs(spark, sf):
    """Relative xywh -> absolute xywh on a 640x480 image."""
    g = _geo(spark, sf)
    return g.select("image_key", "box_pos", *[r6(c).alias(c) for c in ("abs_x", "abs_y", "abs_w", "abs_h")])


@plan("bbox_xyxy", with_(BOXES) + """
SELECT image_key, box_pos, round(x * 640, 6) AS x1, round(y * 480, 6) AS y1,
       round((x + w) * 640, 6) AS x2, round((y + h) * 480, 6) AS y2,
       CAST(trunc(x * 640) AS INTEGER) AS px1, CAST(trunc(y * 480) AS INTEGER) AS py1,
       CAST(trunc(CAST(trunc(x * 640) AS INTEGER) + 640 * w) AS INTEGER) AS px2,
       CAST(trunc(CAST(trunc(y * 480) AS INTEGER) + 480 * h) AS INTEGER) AS py2 FROM boxes""")
def q_bbox_xyxy(spark, sf):
    """Absolute corners, float and integer-pixel variants."""
    g = _geo(spark, sf).withColumns(bx.pixel_xyxy("x", "y", "w", "h", W, H))
    return g.select("image_key", "box_pos", *[r6(c).alias(c) for c in ("x1", "y1", "x2", "y2")],
                    "px1", "py1", "px2", "py2")


@plan("bbox_area", with_(BOXES) + """
SELECT image_key, box_pos, round((w * 640) * (h * 480), 6) AS area FROM boxes""")
def q_bbox_area(spark, sf):
    """Area of the absolute box."""
    return _geo(spark, sf).select("image_key", "box_pos", r6("area").alias("area"))


@plan("bbox_polygon", with_(BOXES) + """
SELECT image_key, box_pos, round(x * 640, 6) AS p0, round(y * 480, 6) AS p1,
       round(x * 640 + w * 640, 6) AS p2, round(y * 480, 6) AS p3,
       round(x * 640 + w * 640, 6) AS p4, round(y * 480 + h * 480, 6) AS p5,
       round(x * 640, 6) AS p6, round(y * 480 + h * 480, 6) AS p7 FROM boxes""")
def q_bbox_polygon(spark, sf):
    """Box -> 8-number polygon."""
    g = _geo(spark, sf)
    return g.select("image_key", "box_pos",
                    *[r6(F.element_at("segmentation", i + 1)).alias(f"p{i}") for i in range(8)])


@plan("crop_window", with_(BOXES) + """,
r AS (SELECT image_key, box_pos, round_even(x * 640, 0)::INTEGER AS r0, round_even(y * 480, 0)::INTEGER AS r1,
             round_even((x + w) * 640, 0)::INTEGER AS r2, round_even((y + h) * 480, 0)::INTEGER AS r3 FROM boxes),
c AS (SELECT *, (r0 + r2) / 2.0 AS cx, (r1 + r3) / 2.0 AS cy,
             floor(1.0 * greatest(r2 - r0, r3 - r1) / 2.0) AS half FROM r)
SELECT image_key, box_pos, CAST(trunc(greatest(0.0, cx - half)) AS INTEGER) AS cx1,
       CAST(trunc(greatest(0.0, cy - half)) AS INTEGER) AS cy1,
       CAST(trunc(cx + half) AS INTEGER) AS cx2, CAST(trunc(cy + half) AS INTEGER) AS cy2 FROM c""")
def q_crop_window(spark, sf):
    """Square crop window (scale 1) around each absolute box."""
    g = _geo(spark, sf).withColumns(bx.crop_window("x1", "y1", "x2", "y2", 1.0))
    return g.select("image_key", "box_pos", "cx1", "cy1", "cx2", "cy2")


@plan("unletterbox", with_(BOXES) + """,
d AS (SELECT image_key, box_pos, x * 320 AS bx1, y * 320 AS by1, (x + w) * 320 AS bx2, (y + h) * 320 AS by2,
             greatest(640, 480) / 320.0 AS scale FROM boxes),
p AS (SELECT *, floor(abs(640 - 640) / (2 * scale)) AS pw, floor(abs(640 - 480) / (2 * scale)) AS ph FROM d)
SELECT image_key, box_pos, CAST(trunc((bx1 - pw) * scale) AS INTEGER) AS fx1,
       CAST(trunc((by1 - ph) * scale) AS INTEGER) AS fy1, CAST(trunc((bx2 - pw) * scale) AS INTEGER) AS fx2,
       CAST(trunc((by2 - ph) * scale) AS INTEGER) AS fy2 FROM p""")
def q_unletterbox(spark, sf):
    """Detector boxes on the 320-px letterbox -> 640x480 frame pixels (padded to 640x640)."""
    b = annotation_boxes(spark, sf).withColumns({
        "bx1": F.col("x") * 320, "by1": F.col("y") * 320,
        "bx2": (F.col("x") + F.col("w")) * 320, "by2": (F.col("y") + F.col("h")) * 320})
    b = b.withColumns(bx.unletterbox("bx1", "by1", "bx2", "by2", W, H, 640, 640, 320))
    return b.select("image_key", "box_pos", "fx1", "fy1", "fx2", "fy2")


@plan("choose_box", with_(IMAGES, BOXES) + """,
k AS (SELECT *, CASE WHEN label = 'no_gesture' THEN 'no_gesture' ELSE 'gesture' END AS kind FROM boxes),
o AS (SELECT *, row_number() OVER (PARTITION BY image_key, kind ORDER BY box_pos DESC, x DESC, y DESC, w DESC, h DESC,
                                   label DESC) AS from_last,
             row_number() OVER (PARTITION BY image_key ORDER BY box_pos, x, y, w, h, label) AS from_first FROM k),
per AS (SELECT image_key, max(kind) FILTER (WHERE from_first = 1) AS first_kind,
               bool_or(kind = 'gesture') AS has_g, bool_or(kind = 'no_gesture') AS has_n
        FROM o GROUP BY image_key),
j AS (SELECT i.image_key, i.name, i.leading_hand, per.first_kind, per.has_g, per.has_n,
             CASE WHEN ('0x' || substr(md5(i.name || '|42|0'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < 0.7
                  THEN 'gesture' ELSE 'no_gesture' END AS drawn
      FROM images i JOIN per ON i.image_key = per.image_key),
c AS (SELECT *, CASE WHEN (drawn = 'gesture' AND has_g) OR (drawn = 'no_gesture' AND has_n)
                     THEN drawn ELSE first_kind END AS choice FROM j)
SELECT c.image_key, c.name, c.choice, b.box_pos, b.label AS gesture,
       CASE WHEN b.label = 'no_gesture' THEN (CASE WHEN c.leading_hand = 'left' THEN 'right' ELSE 'left' END)
            ELSE c.leading_hand END AS leading_hand_class
FROM c JOIN o b ON b.image_key = c.image_key AND b.kind = c.choice AND b.from_last = 1""")
def q_choose_box(spark, sf):
    """Last gesture / last no_gesture box per image, seeded 0.7/0.3 draw,
    fallback to the first box's kind, leading hand flipped for no_gesture; one row per image."""
    c = boxes.choose_box(annotation_images(spark, sf), annotation_boxes(spark, sf), seed=42, epoch=0)
    return c.select("image_key", "name", "choice", "box_pos", "gesture", "leading_hand_class")


@plan("label_codes", with_(BOXES) + """,
codes AS (SELECT unnest(['""" + "', '".join(boxes.CLASSIFIER_TARGETS) + """']) AS label,
                 unnest(range(19))::INTEGER AS code)
SELECT DISTINCT b.label, codes.code FROM boxes b LEFT JOIN codes ON b.label = codes.label""")
def q_label_codes(spark, sf):
    """Class name -> position in the classifier's configured class list."""
    b = annotation_boxes(spark, sf).select("label").distinct()
    return boxes.code_labels(b, "label", boxes.CLASSIFIER_TARGETS, out_col="code")


@plan("existing_images", with_(IMAGES, FILES) + """
SELECT image_key, name FROM images SEMI JOIN files ON images.name = files.name""")
def q_existing_images(spark, sf):
    """annotations whose image file is listed."""
    return boxes.existing_images(annotation_images(spark, sf), image_files(spark, sf)).select("image_key", "name")


@plan("subset_per_class", with_(IMAGES) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY name) AS rn FROM images)
SELECT image_key, name, target FROM r WHERE rn <= 2000""")
def q_subset_per_class(spark, sf):
    """First 2000 files per class in name order."""
    return boxes.subset_per_class(annotation_images(spark, sf), 2000).select("image_key", "name", "target")


@plan("group_split", with_(IMAGES) + """,
u AS (SELECT DISTINCT user_id FROM images),
r AS (SELECT user_id, row_number() OVER (ORDER BY md5(user_id || '42'), user_id) AS rk, count(*) OVER () AS n FROM u)
SELECT i.image_key, i.user_id, CASE WHEN r.rk <= floor(0.8::DOUBLE * r.n) THEN 'train' ELSE 'test' END AS split
FROM images i JOIN r ON i.user_id = r.user_id""")
def q_group_split(spark, sf):
    """80/20 split by user so no user is on both sides."""
    s = sampling.group_split(annotation_images(spark, sf), "user_id", 0.8, seed=42)
    return s.select("image_key", "user_id", "split")


@plan("coco_annotations", with_(IMAGES, BOXES) + """,
codes AS (SELECT unnest(['""" + "', '".join(boxes.CONVERTER_TARGETS) + """']) AS label,
                 unnest(range(19))::INTEGER AS category_id),
im AS (SELECT image_key, row_number() OVER (ORDER BY image_key) - 1 AS image_id FROM images),
b AS (SELECT im.image_id, boxes.*, codes.category_id FROM boxes JOIN im ON boxes.image_key = im.image_key
      LEFT JOIN codes ON boxes.label = codes.label),
a AS (SELECT *, row_number() OVER (ORDER BY image_id, box_pos, x, y, w, h, label, score) - 1 AS id FROM b)
SELECT id, image_id, category_id, round(x * 640, 6) AS abs_x, round(y * 480, 6) AS abs_y,
       round(w * 640, 6) AS abs_w, round(h * 480, 6) AS abs_h, 0 AS iscrowd,
       round((w * 640) * (h * 480), 6) AS area FROM a""")
def q_coco_annotations(spark, sf):
    """COCO annotation table with running ids (image id = rank of the key,
    annotation id = rank over (image id, box position))."""
    _, _, ann = coco(spark, sf)
    return ann.select("id", "image_id", "category_id", *[r6(c).alias(c) for c in ("abs_x", "abs_y", "abs_w", "abs_h")],
                      "iscrowd", r6("area").alias("area"))


def coco(spark, sf):
    b = annotation_boxes(spark, sf)
    return boxes.coco_tables(annotation_images(spark, sf), b, boxes.CONVERTER_TARGETS, W, H,
                             order_cols=["image_id", "box_pos", "x", "y", "w", "h", "label", "score"])


@plan("filter_detections", with_(BOXES) + """,
r AS (SELECT *, row_number() OVER (PARTITION BY image_key ORDER BY box_pos, x, y, w, h, label, score) - 1 AS pos
      FROM boxes)
SELECT image_key, pos::INTEGER AS pos, box_pos, label, round(score, 6) AS score FROM r WHERE pos < 2 AND score > 0.5""")
def q_filter_detections(spark, sf):
    """First 2 detections per image with score > 0.5."""
    d = boxes.filter_detections(annotation_boxes(spark, sf), n=2, threshold=0.5)
    return d.select("image_key", "pos", "box_pos", "label", r6("score").alias("score"))
