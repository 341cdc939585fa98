"""As-of activity snapshots on a report-date grid.

The source program loops over report dates and appends one aggregation per
date.  Here the whole grid is one pass: the grid is a relation joined with the
history on its partition column, so a date-partitioned history is pruned to the
grid's dates when the join runs (dynamic partition pruning), wherever the dates
come from; and one hash aggregation with partial (map-side) combine produces
every snapshot at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.dates import report_grid_relation, to_date_col

# Case-folded user types and the column suffix each one feeds.
USER_TYPES = {"Defult": "default", "Admin": "administrator", "FinMgr": "finance manager"}


def last_activity_by_type(hist: DataFrame, keys: Sequence[str],
                          user_types: Mapping[str, str] = USER_TYPES,
                          login_col: str = "last_login",
                          type_col: str = "dealer_user_type") -> DataFrame:
    """Per key: latest login overall and per (case-folded) user type."""
    kind = F.lower(F.col(type_col))
    aggs = [F.max(login_col).alias("Last_Login_anyuser")]
    aggs += [F.max(F.when(kind == value, F.col(login_col))).alias(f"Last_Login_{suffix}")
             for suffix, value in user_types.items()]
    return hist.groupBy(*keys).agg(*aggs)


def grid_frame(hist: DataFrame, report_dates: Sequence[dt.date]) -> DataFrame:
    """Report dates as a relation; a date given twice is one report."""
    rows = [(day,) for day in dict.fromkeys(report_dates)]
    return hist.sparkSession.createDataFrame(rows, "report_date date")


def activity_snapshots(hist: DataFrame, report_dates: Sequence[dt.date] | DataFrame,
                       user_types: Mapping[str, str] = USER_TYPES,
                       partition_col: str = "partition_date",
                       dealer_col: str = "dealership_id") -> DataFrame:
    """Snapshot rows for every report date of the grid (11 columns).

    A row of ``hist`` belongs to report date i when its partition date, cast
    to DATE, equals i; rows without a dealer are dropped.  ``report_dates`` is
    a list, or a relation with a ``report_date`` column.
    """
    snap = snapshot_logins(hist, report_dates, user_types, partition_col, dealer_col)
    return with_days_since(snap, user_types)


def snapshot_logins(hist: DataFrame, report_dates: Sequence[dt.date] | DataFrame,
                    user_types: Mapping[str, str] = USER_TYPES,
                    partition_col: str = "partition_date",
                    dealer_col: str = "dealership_id") -> DataFrame:
    """Latest logins per (report date, partition, dealer); the mergeable part of a snapshot.

    The grid is one date per report, bounded by the calendar, and is broadcast.  A list is an
    ``IN`` on the partition column as well, which a scan can push; a relation prunes at run time.
    """
    report = to_date_col(partition_col)
    rows = hist.where(F.col(dealer_col).isNotNull())
    if isinstance(report_dates, DataFrame):
        # a comparison on the grid side tells the planner that pruning by it pays
        grid = report_dates.where("report_date >= date'0001-01-01'").distinct()
    else:
        rows, grid = rows.where(report.isin(list(report_dates))), grid_frame(hist, report_dates)
    grid = grid.select(F.col("report_date").alias("Report_Date"))
    rows = rows.join(F.broadcast(grid), report == F.col("Report_Date"))
    snap = last_activity_by_type(rows, ["Report_Date", partition_col, dealer_col], user_types)
    return snap.select("Report_Date", F.col(partition_col).alias("partition_date"),
                       F.col(dealer_col).alias("Dealership_id"), "Last_Login_anyuser",
                       *[f"Last_Login_{s}" for s in user_types])


def with_days_since(snap: DataFrame, user_types: Mapping[str, str] = USER_TYPES) -> DataFrame:
    """Adds the whole days from each latest login to the report date."""
    suffixes = {"AnyUser": "anyuser", **{s: s for s in user_types}}
    days = [F.datediff(F.col("Report_Date"), to_date_col(f"Last_Login_{src}"))
            .alias(f"Day_sin_lastlog_{name}") for name, src in suffixes.items()]
    return snap.select("*", *days)


def activity_snapshots_on_grid(hist: DataFrame, first: dt.date | str, last: dt.date | str,
                               step_months: int, **kwargs) -> DataFrame:
    """Grid (do-while month steps) + snapshots, as the procedure call does."""
    bounds = hist.sparkSession.range(1).select(F.lit(str(first)).alias("first"), F.lit(str(last)).alias("last"))
    return activity_snapshots(hist, report_grid_relation(bounds, step_months), **kwargs)


def history_grid(hist: DataFrame, step_months: int, partition_col: str = "partition_date") -> DataFrame:
    """The report grid over the history's own span, from its first partition to its last."""
    span = hist.agg(F.min(to_date_col(partition_col)).alias("first"), F.max(to_date_col(partition_col)).alias("last"))
    return report_grid_relation(span, step_months)
