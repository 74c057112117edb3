"""Rectangle maths on four coordinate columns, top-left origin, in points.

A rectangle is addressed by a column-name prefix: ``box("")`` reads ``x0`` …
``y1``; ``box("r_")`` reads ``r_x0`` … ``r_y1``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x0: Column
    y0: Column
    x1: Column
    y1: Column


def box(prefix: str = "") -> Box:
    return Box(*(F.col(prefix + c) for c in ("x0", "y0", "x1", "y1")))


def width(b: Box) -> Column:
    return b.x1 - b.x0


def height(b: Box) -> Column:
    return b.y1 - b.y0


def center_x(b: Box) -> Column:
    return (b.x0 + b.x1) / 2


def center_y(b: Box) -> Column:
    return (b.y0 + b.y1) / 2


def rect_area(b: Box) -> Column:
    """Area; a degenerate rectangle has none."""
    return F.greatest(F.lit(0.0), width(b)) * F.greatest(F.lit(0.0), height(b))


def overlap_x(a: Box, b: Box) -> Column:
    """Shared horizontal extent; negative values are the gap."""
    return F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)


def overlap_y(a: Box, b: Box) -> Column:
    return F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)


def overlap_area(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0.0), overlap_x(a, b)) * F.greatest(F.lit(0.0), overlap_y(a, b))


def rect_iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union is empty."""
    shared = overlap_area(a, b)
    union = rect_area(a) + rect_area(b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def center_dist(a: Box, b: Box) -> Column:
    return F.hypot(center_x(a) - center_x(b), center_y(a) - center_y(b))


def chebyshev(a: Box, b: Box) -> Column:
    """Largest of the two centre offsets."""
    return F.greatest(
        F.abs(center_x(a) - center_x(b)), F.abs(center_y(a) - center_y(b))
    )


def contains_point(b: Box, x: Column, y: Column) -> Column:
    return (x >= b.x0) & (x <= b.x1) & (y >= b.y0) & (y <= b.y1)


def x_overlaps(a: Box, b: Box) -> Column:
    return (a.x0 < b.x1) & (a.x1 > b.x0)


def y_overlaps(a: Box, b: Box, margin: float = 0.0) -> Column:
    return (a.y0 < b.y1 + margin) & (a.y1 > b.y0 - margin)
