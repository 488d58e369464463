"""Box geometry and box choice."""

from quiver.functions import boxes as bx
from quiver.operators import boxes


def test_crop_window_rounding_and_clamp(spark):
    df = spark.createDataFrame([(2.5, 3.5, 10.5, 7.5)], "x1 double, y1 double, x2 double, y2 double")
    r = df.select(*[v.alias(k) for k, v in bx.crop_window("x1", "y1", "x2", "y2", 1.0).items()]).collect()[0]
    # rint half-even: 2, 4, 10, 8 -> centre (6, 6), side 8, half 4
    assert (r.cx1, r.cy1, r.cx2, r.cy2) == (2, 2, 10, 10)
    df2 = spark.createDataFrame([(0.0, 0.0, 20.0, 4.0)], "x1 double, y1 double, x2 double, y2 double")
    r2 = df2.select(*[v.alias(k) for k, v in bx.crop_window("x1", "y1", "x2", "y2", 1.5).items()]).collect()[0]
    assert r2.cy1 == 0 and r2.cy2 == 17  # lower bound clamped, upper not


def test_pixel_xyxy_truncates_before_adding(spark):
    df = spark.createDataFrame([(0.51, 0.5, 0.25, 0.25)], "x double, y double, w double, h double")
    r = df.select(*[v.alias(k) for k, v in bx.pixel_xyxy("x", "y", "w", "h", 3, 3).items()]).collect()[0]
    assert (r.px1, r.px2) == (1, 1)  # int(1.53) = 1, int(1 + 0.75) = 1


def test_choose_box_fallback_and_hand_flip(spark):
    imgs = spark.createDataFrame([("a", "a.jpg", "right"), ("b", "b.jpg", "left")],
                                 "image_key string, name string, leading_hand string")
    bxs = spark.createDataFrame([("a", 1, 0.1, 0.1, 0.1, 0.1, "no_gesture"), ("b", 1, 0.1, 0.1, 0.1, 0.1, "call"),
                                 ("b", 2, 0.2, 0.2, 0.1, 0.1, "rock")],
                                "image_key string, box_pos int, x double, y double, w double, h double, label string")
    out = {r.image_key: r for r in boxes.choose_box(imgs, bxs).collect()}
    assert out["a"].choice == "no_gesture" and out["a"].leading_hand_class == "left"  # only kind present; flipped
    assert out["b"].choice == "gesture" and out["b"].box_pos == 2  # last gesture box wins


def test_unletterbox(spark):
    df = spark.createDataFrame([(10.0, 50.0, 20.0, 60.0)], "a double, b double, c double, d double")
    r = df.select(*[v.alias(k) for k, v in bx.unletterbox("a", "b", "c", "d", 640, 480, 640, 640).items()]).collect()[0]
    # scale 2, pad_h = 160 // 4 = 40
    assert (r.fx1, r.fy1, r.fx2, r.fy2) == (20, 20, 40, 40)
