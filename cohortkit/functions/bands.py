"""Tolerance bands used to qualify peers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def size_band(col: str | Column, tol: float = 0.25) -> tuple[Column, Column]:
    """``[x(1-tol), x(1+tol)]`` as doubles; both ends NULL when x <= 0."""
    x = _c(col).cast("double")
    positive = _c(col) > 0
    return (F.when(positive, x * (1 - tol)), F.when(positive, x * (1 + tol)))


def growth_band(col: str | Column, tol: float) -> tuple[Column, Column]:
    """Sign-aware relative band around a growth rate g.

    g > 0: [g(1-t), g(1+t)];  g < 0: [g(1+t), g(1-t)];  g = 0: [-t, t];
    NULL g gives a NULL band (no peer can fall inside it).
    """
    g = _c(col).cast("double")
    low = (F.when(g > 0, g * (1 - tol)).when(g < 0, g * (1 + tol))
           .when(g == 0, F.lit(-tol)))
    high = (F.when(g > 0, g * (1 + tol)).when(g < 0, g * (1 - tol))
            .when(g == 0, F.lit(tol)))
    return low, high
