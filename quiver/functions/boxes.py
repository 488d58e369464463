"""Bounding-box column arithmetic (S12-S17). Boxes are relative [x, y, w, h]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def abs_xywh(x, y, w, h, width, height) -> dict:
    """Relative xywh -> absolute xywh."""
    return {"abs_x": _c(x) * _c(width), "abs_y": _c(y) * _c(height),
            "abs_w": _c(w) * _c(width), "abs_h": _c(h) * _c(height)}


def abs_xyxy(x, y, w, h, width, height) -> dict:
    """Relative xywh -> absolute corners [x1, y1, x2, y2]."""
    return {"x1": _c(x) * _c(width), "y1": _c(y) * _c(height),
            "x2": (_c(x) + _c(w)) * _c(width), "y2": (_c(y) + _c(h)) * _c(height)}


def pixel_xyxy(x, y, w, h, width, height) -> dict:
    """S13 integer variant: x1 truncated first, then the scaled width added and truncated."""
    x1 = (_c(x) * _c(width)).cast("int")
    y1 = (_c(y) * _c(height)).cast("int")
    return {"px1": x1, "py1": y1,
            "px2": (x1 + _c(width) * _c(w)).cast("int"), "py2": (y1 + _c(height) * _c(h)).cast("int")}


def area(abs_w, abs_h) -> Column:
    """Box area from absolute width and height."""
    return _c(abs_w) * _c(abs_h)


def polygon(abs_x, abs_y, abs_w, abs_h) -> Column:
    """[xmin, ymin, xmax, ymin, xmax, ymax, xmin, ymax]."""
    x0, y0 = _c(abs_x), _c(abs_y)
    x1, y1 = x0 + _c(abs_w), y0 + _c(abs_h)
    return F.array(x0, y0, x1, y0, x1, y1, x0, y1)


def crop_window(x1, y1, x2, y2, box_scale=1.0) -> dict:
    """Square crop around an absolute xyxy box.

    Corners are rounded half-to-even to int; side = max(w, h); half extent =
    floor(scale * side / 2); the lower bounds are clamped at 0, the upper
    ones are not; results truncate to int."""
    r = [F.rint(_c(v)).cast("int") for v in (x1, y1, x2, y2)]
    cx = (r[0] + r[2]) / 2.0
    cy = (r[1] + r[3]) / 2.0
    side = F.greatest(r[2] - r[0], r[3] - r[1])
    half = F.floor(_c(box_scale) * side / 2.0)
    return {"cx1": F.greatest(F.lit(0.0), cx - half).cast("int"),
            "cy1": F.greatest(F.lit(0.0), cy - half).cast("int"),
            "cx2": (cx + half).cast("int"), "cy2": (cy + half).cast("int")}


def unletterbox(bx1, by1, bx2, by2, width, height, padded_width, padded_height, size: int = 320) -> dict:
    """Detector box on the ``size`` letterboxed square -> frame pixels."""
    scale = F.greatest(_c(width), _c(height)) / float(size)
    pad_w = F.floor(F.abs(_c(padded_width) - _c(width)) / (2 * scale))
    pad_h = F.floor(F.abs(_c(padded_height) - _c(height)) / (2 * scale))
    return {"fx1": ((_c(bx1) - pad_w) * scale).cast("int"), "fy1": ((_c(by1) - pad_h) * scale).cast("int"),
            "fx2": ((_c(bx2) - pad_w) * scale).cast("int"), "fy2": ((_c(by2) - pad_h) * scale).cast("int")}
