"""Row predicates and labels used by the contest metrics and the lift report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the source programs for the same results):
# vehicle classes that never qualify; a missing class counts as 'na'.
EXCLUDED_VEHICLE_CLASSES = ("mower", "trailer", "tractor", "rv", "automobile", "na")
# Tier labels searched, in this order, inside the tier text.
TIER_LABELS = ("A1", "A2", "A3", "B1", "B2", "B3")
# Loyalty levels, highest first; the top two count as level-ups.
TOP_LEVELS = ("MVP", "All-Star")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def vehicle_class_filter(col: str | Column = "vehicle_type",
                         excluded: Sequence[str] = EXCLUDED_VEHICLE_CLASSES) -> Column:
    """True when the case-folded class is not excluded; NULL is treated as 'na'."""
    return ~F.coalesce(F.lower(_c(col)), F.lit("na")).isin(list(excluded))


def tier_prefix(col: str | Column, prefix: str) -> Column:
    """``LIKE 'prefix%'`` (NULL tier never matches)."""
    return _c(col).startswith(prefix)


def tier_label(col: str | Column, labels: Sequence[str] = TIER_LABELS) -> Column:
    """First label found as a substring of the tier text, else the raw text."""
    col = _c(col)
    out = None
    for label in labels:
        cond = col.contains(label)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(col)


def level_up(status: str | Column, prior: str | Column,
             top_levels: Sequence[str] = TOP_LEVELS) -> Column:
    """0/1 flag: the state entered one of the top levels from below it.

    For each j, the top-j set T_j: prior NOT IN T_j and status IN T_j.
    Three-valued logic is kept: a NULL prior is unknown, hence no level-up.
    """
    status, prior = _c(status), _c(prior)
    cond = None
    for j in range(1, len(top_levels) + 1):
        top = list(top_levels[:j])
        term = (~prior.isin(top)) & status.isin(top)
        cond = term if cond is None else (cond | term)
    return F.when(cond, 1).otherwise(0)
