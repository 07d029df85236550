"""Box and mask-grid expressions on columns.  A box is four double columns x1, y1, x2, y2 with an optional prefix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2"))


def area(a: Box) -> Column:
    return (a[2] - a[0]) * (a[3] - a[1])


def height(a: Box) -> Column:
    return a[3] - a[1]


def intersection(a: Box, b: Box) -> Column:
    side = lambda k: F.greatest(F.lit(0.0), F.least(a[k + 2], b[k + 2]) - F.greatest(a[k], b[k]))
    return side(0) * side(1)


def iou(a: Box, b: Box) -> Column:
    """0 where the boxes do not overlap or the union is empty."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when((inter <= 0) | (union <= 0), F.lit(0.0)).otherwise(inter / union)


def coverage(a: Box, b: Box) -> Column:
    """Share of `a` that `b` covers."""
    return intersection(a, b) / F.greatest(area(a), F.lit(1e-6))


def center(a: Box) -> tuple[Column, Column]:
    return (a[0] + a[2]) / 2, (a[1] + a[3]) / 2


def distance(a: Box, b: Box) -> Column:
    (ax, ay), (bx, by) = center(a), center(b)
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def near(a: Box, b: Box) -> Column:
    """Overlap of at least 0.3, or centres closer than half the larger height."""
    return (iou(a, b) >= 0.3) | (distance(a, b) < 0.5 * F.greatest(height(a), height(b)))


def on_edge(a: Box, width: float, high: float, margin: float = 2.0) -> Column:
    return (a[0] <= margin) | (a[1] <= margin) | (a[2] >= width - margin) | (a[3] >= high - margin)


def view_quality(score: Column, a: Box, width: float, high: float) -> Column:
    """score * sqrt(area), halved on the frame's edge."""
    return score * F.sqrt(F.greatest(F.lit(1.0), area(a))) * F.when(on_edge(a, width, high), 0.5).otherwise(1.0)


def to_grid(a: Box, cell: float) -> tuple[Column, Column, Column, Column]:
    """Half-open cell ranges that a box touches: floor of the near sides, ceiling of the far ones."""
    return F.floor(a[0] / cell), F.floor(a[1] / cell), F.ceil(a[2] / cell), F.ceil(a[3] / cell)


def from_xywh(x: Column, y: Column, w: Column, h: Column) -> Box:
    return x, y, x + w, y + h


def from_cxcywh(cx: Column, cy: Column, w: Column, h: Column, width: float, high: float) -> Box:
    """Normalised centre boxes to pixels."""
    return (cx - w / 2) * width, (cy - h / 2) * high, (cx + w / 2) * width, (cy + h / 2) * high


def clipped(a: Box, width: float, high: float) -> Box:
    low = lambda x, top: F.greatest(F.lit(0.0), F.least(x, F.lit(float(top))))
    return low(a[0], width), low(a[1], high), low(a[2], width), low(a[3], high)
