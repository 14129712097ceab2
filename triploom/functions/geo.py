"""Bounding boxes over (x, y) = (longitude, latitude) points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _num(v) -> float:
    """Corner value: blank or missing counts as 0.0; text is read as a number."""
    if v is None:
        return 0.0
    if isinstance(v, str):
        v = v.strip()
        return float(v) if v else 0.0
    return float(v)


@dataclass(frozen=True)
class Box:
    """Closed box; built from any two opposite corners."""

    x_min: float
    x_max: float
    y_min: float
    y_max: float

    @classmethod
    def from_corners(cls, x_a, y_a, x_b, y_b) -> "Box":
        xa, ya, xb, yb = _num(x_a), _num(y_a), _num(x_b), _num(y_b)
        return cls(min(xa, xb), max(xa, xb), min(ya, yb), max(ya, yb))


def in_box(x, y, box: Box) -> Column:
    """Closed-box test: edges are inside."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return (x.between(F.lit(box.x_min), F.lit(box.x_max))
            & y.between(F.lit(box.y_min), F.lit(box.y_max)))
