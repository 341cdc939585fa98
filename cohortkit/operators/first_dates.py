"""First dates of keys as a table that grows: an unbounded look-back without reading the past again.

A first event "ever" is a minimum over all history.  The minima of two stretches of time merge into
the minimum of both, so the state -- one row per key -- is extended by the partitions that came since,
and the question "whose first event falls into this window" is asked of the state alone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators.sink import drop_path, path_exists, swap_paths

KEYS = ("region", "dealership_id")


def first_dates(events: DataFrame, date_col: str, keys: Sequence[str] = KEYS,
                where: Column | None = None) -> DataFrame:
    """(keys, first_date) of the qualifying events: one hash aggregation with partial combine."""
    rows = events.where(F.col(date_col).isNotNull() if where is None else F.col(date_col).isNotNull() & where)
    return rows.groupBy(*keys).agg(F.min(F.col(date_col).cast("date")).alias("first_date"))


def merge_first_dates(earlier: DataFrame, later: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The state of both stretches of time.  A null key is a key."""
    return earlier.unionByName(later).groupBy(*keys).agg(F.min("first_date").alias("first_date"))


def first_in_window(state: DataFrame, start: dt.date, end: dt.date, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys whose first event falls in [start, end], as ``first_event_in_window`` gives them.

    The state must reach ``end``; what it holds of later days changes nothing, as a later event
    is no first one of the window.
    """
    return state.where(F.col("first_date").between(F.lit(start), F.lit(end))).select(
        *keys, F.col("first_date").alias("date"))


class FirstDates:
    """The state kept at a shared path: the first dates, and the day they reach.

    Both stand in one folder that is replaced by a swap, so a failed update leaves the earlier state,
    and an update that ran to the end but is run again adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = KEYS,
                 since: dt.date | None = None):
        self.spark, self.path, self.keys, self.since = spark, path.rstrip("/"), tuple(keys), since

    def through(self) -> dt.date | None:
        """The last day the state has seen; None before the first update."""
        if not path_exists(self.spark, f"{self.path}/through"):
            return None
        return self.spark.read.parquet(f"{self.path}/through").first()[0]

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/first_dates")

    def update(self, events: DataFrame, upto: dt.date, date_col: str, where: Column | None = None) -> dt.date:
        """Take in the events after the state's day and up to ``upto``; returns the day the state reaches.

        The dates bound the scan, so only partitions that came since are read.  Events that arrive
        for a day already taken in are not seen: update with a day that is complete.
        """
        done = self.through()
        if done is not None and upto <= done:
            return done
        d = F.col(date_col)
        fresh = events.where(d <= F.lit(upto))
        if done is not None:
            fresh = fresh.where(d > F.lit(done))
        if self.since is not None:
            fresh = fresh.where(d >= F.lit(self.since))
        state = first_dates(fresh, date_col, self.keys, where)
        if done is not None:
            state = merge_first_dates(self.read(), state, self.keys)
        staged = f"{self.path}.staged-{uuid.uuid4().hex[:12]}"
        try:
            state.write.parquet(f"{staged}/first_dates")
            self.spark.createDataFrame([(upto,)], "through date").coalesce(1).write.parquet(f"{staged}/through")
            swap_paths(self.spark, staged, self.path)
        finally:
            drop_path(self.spark, staged)
        return upto
