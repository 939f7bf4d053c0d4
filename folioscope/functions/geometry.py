"""Boxes: pixels at OCR resolution, points, and fractions of a page. Column expressions only.

A polygon is an array of [x, y] points; its box is [x0, y0, x1, y1], the least and largest of all points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OCR_DPI, POINTS_PER_INCH = 300, 72


def box_of_polygon(polygon: Column, points: int | None = None) -> Column:
    """The box of a polygon, null for a null or empty one.

    With ``points`` known, four in OCR pages, the expression has no higher-order function and stays in
    whole-stage code.
    """
    if points:
        xs, ys = ([F.get(F.get(polygon, F.lit(i)), F.lit(k)) for i in range(points)] for k in (0, 1))
        low, high = (F.least, F.greatest) if points > 1 else ((lambda x: x),) * 2
        return F.when(F.size(polygon) > 0, F.array(low(*xs), low(*ys), high(*xs), high(*ys)))
    xs, ys = F.transform(polygon, lambda p: F.get(p, F.lit(0))), F.transform(polygon, lambda p: F.get(p, F.lit(1)))
    return F.when(F.size(polygon) > 0, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def normalised(box: Column, width_pt: Column, height_pt: Column) -> Column:
    """A pixel box at OCR_DPI as fractions of a page of the given size in points; neither clamped nor rounded."""
    scale = OCR_DPI / POINTS_PER_INCH
    w, h = width_pt * scale, height_pt * scale
    return F.array(box[0] / w, box[1] / h, box[2] / w, box[3] / h)


def denormalised(box: Column, width: Column, height: Column) -> Column:
    """A box of fractions in pixels of an image of the given size."""
    return F.array(box[0] * width, box[1] * height, box[2] * width, box[3] * height)


def parsed_box(text: Column) -> Column:
    """``x0,y0,x1,y1`` as four doubles, blanks around them allowed; null unless there are exactly four numbers."""
    parts = F.split(text, ",", -1)
    values = [F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in range(4)]
    ok = F.size(parts) == 4
    for v in values:
        ok = ok & v.isNotNull()
    return F.when(ok, F.array(*values))


def out_of_range(box: Column) -> Column:
    """Whether a coordinate exceeds 1: the box is reported, but still taken."""
    return F.greatest(*[box[i] for i in range(4)]) > 1


def valid(box: Column) -> Column:
    """The stricter test: 0 <= x0 < x1 <= 1 and 0 <= y0 < y1 <= 1."""
    return (box[0] >= 0) & (box[0] < box[2]) & (box[2] <= 1) & (box[1] >= 0) & (box[1] < box[3]) & (box[3] <= 1)


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes; 0 where they don't meet or have no area."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def rotated(x: Column, y: Column, degrees: Column) -> tuple[Column, Column]:
    """A point turned about the origin by an angle whose sign the caller has fitted to the data."""
    r = F.radians(degrees)
    return x * F.cos(r) - y * F.sin(r), x * F.sin(r) + y * F.cos(r)
