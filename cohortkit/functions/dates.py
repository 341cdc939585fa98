"""Month arithmetic and the stepped report grid.

All month work is done on DATE values (``trunc(d, 'MM')`` stays a DATE), so
results do not depend on the session time zone.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_date_col(col: str | Column) -> Column:
    """Cast a date, timestamp or date-like string to DATE."""
    return _c(col).cast("date")


def month_start(col: str | Column) -> Column:
    """First day of the month of ``col`` as a DATE."""
    return F.trunc(to_date_col(col), "MM")


def month_later(col: str | Column) -> Column:
    """One month after ``col``, less one day (the end of its month for a first of the month)."""
    return F.date_sub(F.add_months(to_date_col(col), 1), 1)


def month_diff(start: str | Column, end: str | Column) -> Column:
    """Whole months from ``start`` to ``end``; both are month starts.

    ``months_between`` is exact for two first-of-month dates, so the cast
    to int loses nothing.
    """
    return F.months_between(_c(end), _c(start)).cast("int")


def add_months_py(day: dt.date, months: int) -> dt.date:
    """Calendar month add with the day clipped to the target month's end.

    Same rule as Spark's ``add_months``: 31 Jan + 1 month = 28/29 Feb, and the
    clipped day is carried into the next step when the grid is iterated.
    """
    idx = day.month - 1 + months
    year, month = day.year + idx // 12, idx % 12 + 1
    last = calendar.monthrange(year, month)[1]
    return dt.date(year, month, min(day.day, last))


def year_before(day: dt.date) -> dt.date:
    """The same day a year earlier; the last day of a month stays the last day of its month."""
    if day.day == calendar.monthrange(day.year, day.month)[1]:
        return dt.date(day.year - 1, day.month, calendar.monthrange(day.year - 1, day.month)[1])
    return dt.date(day.year - 1, day.month, day.day)


def report_grid(first: dt.date | str, last: dt.date | str, step_months: int) -> list[dt.date]:
    """Report dates: ``first``, then repeated month steps until a date >= ``last``.

    The loop is do-while: the second date is always produced and the last
    date may overshoot ``last``.  Each step starts from the previous (clipped)
    date, so month-end dates drift.  A step <= 0 would never end and is
    rejected.  The grid is a handful of scalar arguments, so it lives on the
    driver.
    """
    if step_months <= 0:
        raise ValueError(f"step_months must be positive, got {step_months}")
    first = dt.date.fromisoformat(first) if isinstance(first, str) else first
    last = dt.date.fromisoformat(last) if isinstance(last, str) else last
    dates = [first]
    current = first
    while True:
        current = add_months_py(current, step_months)
        dates.append(current)
        if current >= last:
            return dates


def report_grid_relation(bounds: DataFrame, step_months: int, first_col: str = "first",
                         last_col: str = "last") -> DataFrame:
    """The dates of ``report_grid`` as a relation (``report_date``), from rows of (first, last).

    ``bounds`` may come from data (the span of a history) or from literals; each of its rows gives
    its own grid, and a row with a null bound none.  The do-while runs in one expression: a step is
    added while it is the first or the date before it is under ``last``, so month ends drift as in
    ``report_grid``.  The steps between the bounds and one more are enough, as a step from a clipped
    date is never shorter than to the next month of the grid.
    """
    if step_months <= 0:
        raise ValueError(f"step_months must be positive, got {step_months}")
    first, last = _c(first_col).cast("date"), _c(last_col).cast("date")
    steps = F.greatest(F.lit(1), F.ceil(F.months_between(F.last_day(last), F.trunc(first, "MM")) / step_months) + 1)
    latest = lambda dates: F.element_at(dates, -1)
    grid = F.aggregate(
        F.sequence(F.lit(1), steps.cast("int")), F.array(first),
        lambda dates, i: F.when((i == 1) | (latest(dates) < last),
                                F.concat(dates, F.array(F.add_months(latest(dates), step_months)))).otherwise(dates))
    known = bounds.where(first.isNotNull() & last.isNotNull())
    return known.select(F.explode(grid).alias("report_date"))
