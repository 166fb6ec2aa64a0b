"""Boxes [x0, y0, x1, y1], as expressions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = Sequence[Column]


def box(array: Column) -> list[Column]:
    """The four numbers of a box stored as an array; null where it is shorter."""
    return [F.get(array, F.lit(i)) for i in range(4)]


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def intersection(a: Box, b: Box) -> Column:
    wide = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    high = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where they don't overlap."""
    common = intersection(a, b)
    return F.when(common == 0, 0.0).otherwise(common / (area(a) + area(b) - common))


def touches(a: Box, b: Box) -> Column:
    """Whether the closed boxes meet: the cheap test before the exact one."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def weighted_distance(a: Box, b: Box, wx: float = 50.0, wy: float = 1.0) -> Column:
    """Distance of the centres, the axes weighted under the root."""
    dx, dy = (a[0] + a[2]) / 2 - (b[0] + b[2]) / 2, (a[1] + a[3]) / 2 - (b[1] + b[3]) / 2
    return F.sqrt(F.lit(float(wx)) * dx * dx + F.lit(float(wy)) * dy * dy)
