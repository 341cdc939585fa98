"""Qualifying-event metrics: thresholds, first events, enrolments, level-ups.

Every metric returns ``(region, dealership_id, date)`` rows (plus its own
diagnostic columns); the contest plan stamps team / metric id / name on them.

Running totals and row numbers "within a dealer-month, by date" are taken
on a day-level pre-aggregate: rows are first combined per (dealer, month,
day) by a hash aggregate (map-side partial combine), then the windows run
over one dealer-month, i.e. at most 31 day rows, however hot the dealer is.
Rows of one dealer-month are ordered by (date, region), NULL regions first;
rows of one region-day are alike, so the region-day that holds the n-th row
or reaches a total is the same as at row level (counts are assumed >= 0) and
exactly one region-day holds the n-th row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.dates import month_later, month_start, to_date_col, year_before
from cohortkit.functions.predicates import (EXCLUDED_VEHICLE_CLASSES, TOP_LEVELS, level_up, tier_prefix,
                                            vehicle_class_filter)

# Application types counted as dealer activity.
DEALER_APP_TYPES = ("Dealer", "lightspeed")


def funded_rows(fact: DataFrame, start: dt.date | None, end: dt.date,
                case_sensitive: bool = True, vehicle_filter: bool = True,
                excluded_classes: Sequence[str] = EXCLUDED_VEHICLE_CLASSES) -> DataFrame:
    """Funded fact rows in [start, end] (start None: no lower bound)."""
    d = F.col("funding_pending_date")
    cond = d <= F.lit(end) if start is None else d.between(F.lit(start), F.lit(end))
    funded = (F.col("is_funded") == "Yes") if case_sensitive else (F.lower("is_funded") == "yes")
    if vehicle_filter:
        cond = cond & vehicle_class_filter(excluded=excluded_classes)
    return fact.where(cond & funded)


def day_ladder(rows: DataFrame, part_keys: Sequence[str], date_col: str,
               units_col: str | None = None, attr_keys: Sequence[str] = ()) -> DataFrame:
    """One row per (attr, part, day) with running totals within ``part_keys`` by day.

    Columns: ``_rows``/``_units`` of the day row, ``_rows_before`` (earlier
    rows), ``_rows_through``/``_units_through`` (up to and including the row),
    ``_units_total`` (whole partition).
    """
    units = F.sum(units_col) if units_col else F.count(F.lit(1))
    daily = rows.groupBy(*attr_keys, *part_keys, date_col).agg(
        F.count(F.lit(1)).alias("_rows"), units.alias("_units"))
    return ladder_from_days(daily, part_keys, date_col, attr_keys)


def ladder_from_days(daily: DataFrame, part_keys: Sequence[str], date_col: str,
                     attr_keys: Sequence[str] = ()) -> DataFrame:
    """Running totals within ``part_keys`` over day rows carrying ``_rows``/``_units``.

    Total order: the day, then the attributes (NULLs first).  A partition is
    one dealer-month: at most 31 days times its regions.
    """
    w = Window.partitionBy(*part_keys).orderBy(date_col, *[F.col(c).asc_nulls_first() for c in attr_keys])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    through = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "*",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(through).alias("_rows_through"),
        F.sum("_units").over(through).alias("_units_through"),
        F.sum("_units").over(Window.partitionBy(*part_keys)).alias("_units_total"))


def funded_days(fact: DataFrame, start: dt.date | None, end: dt.date,
                region_col: str = "rsm_territory_regions__c",
                excluded_classes: Sequence[str] = EXCLUDED_VEHICLE_CLASSES) -> DataFrame:
    """Funded qualifying rows (case-sensitive, vehicle class) combined per (region, dealer, day).

    ``_rows`` counts rows (for n-th row rules), ``_units`` sums ``count``
    (for month totals).  Built with a partial + final hash aggregate, so the
    raw rows never cross the network; every fact metric of the contest can be
    answered from these day rows.
    """
    return (funded_rows(fact, start, end, excluded_classes=excluded_classes)
            .groupBy(F.col(region_col).alias("region"), "dealership_id", "funding_pending_date")
            .agg(F.count(F.lit(1)).alias("_rows"), F.sum("count").alias("_units")))


def _in_window(start: dt.date, end: dt.date) -> Column:
    return F.col("funding_pending_date").between(F.lit(start), F.lit(end))


def _ladder(days: DataFrame) -> DataFrame:
    with_month = days.withColumn("month", month_start("funding_pending_date"))
    return ladder_from_days(with_month, ["dealership_id", "month"], "funding_pending_date", ["region"])


def cumulative_threshold_date(rows: DataFrame, n: int, keys: Sequence[str] = ("dealership_id",),
                              date_col: str = "funding_pending_date",
                              units_col: str = "count") -> DataFrame:
    """Per key and month: the day on which the running sum within the month first reaches n.

    Output: keys, ``month``, ``month_tot``, ``reach_date`` (NULL if never).
    """
    ladder = day_ladder(rows.withColumn("month", month_start(date_col)), [*keys, "month"],
                        date_col, units_col)
    return ladder.groupBy(*keys, "month").agg(
        F.max("_units_total").alias("month_tot"),
        F.min(F.when(F.col("_units_through") >= n, F.col(date_col))).alias("reach_date"))


def yoy_new_threshold(fact: DataFrame, account: DataFrame, n: int, start: dt.date, end: dt.date,
                      tier: str | None = "A", region_col: str = "rsm_territory_regions__c") -> DataFrame:
    """New n+ dealer: a month of the window reaches n while the same month a year before did not.

    Rows: funded (case-sensitive), qualifying vehicle class, dealer tier
    prefix, dated in [start, end] or the same window one year earlier.  Per
    (region, dealer, month of year): ``date`` = day the current-year running
    total reached n, ``py_mm_fund`` / ``cy_mm_fund`` = month totals.  A row
    belongs to the window that holds its date, so a window may cross a year
    end; it must not be longer than a year.
    """
    days = funded_days(fact, year_before(start), end, region_col)
    return yoy_new_threshold_days(days, account, n, start, end, tier)


def yoy_new_threshold_days(days: DataFrame, account: DataFrame, n: int, start: dt.date,
                           end: dt.date, tier: str | None = "A") -> DataFrame:
    """``yoy_new_threshold`` over ``funded_days`` rows."""
    py_start, py_end = year_before(start), year_before(end)
    rows = days.where(_in_window(start, end) | _in_window(py_start, py_end))
    if tier is not None:
        dealers = (account.where(tier_prefix("powersports_sales_tier__c", tier))
                   .select(F.col("dealership_id__c").alias("_acc_id")))
        rows = rows.join(dealers, rows.dealership_id == dealers._acc_id, "left_semi")
    ladder = _ladder(rows)
    current = _in_window(start, end)
    reached = F.when(F.col("_units_through") >= n, F.col("funding_pending_date"))
    out = ladder.groupBy("region", "dealership_id", F.month("month").alias("mm")).agg(
        F.min(F.when(current, reached)).alias("date"),
        F.max(F.when(~current, F.col("_units_total")).otherwise(0)).alias("py_mm_fund"),
        F.max(F.when(current, F.col("_units_total")).otherwise(0)).alias("cy_mm_fund"))
    return out.where((F.col("py_mm_fund") < n) & (F.col("cy_mm_fund") >= n))


def first_event_in_window(events: DataFrame, start: dt.date, end: dt.date,
                          date_col: str, keys: Sequence[str] = ("region", "dealership_id"),
                          lookback_start: dt.date | None = None,
                          where: Column | None = None) -> DataFrame:
    """Keys whose first qualifying event since ``lookback_start`` (or ever) falls in [start, end].

    One hash aggregation (min) per key; partial aggregation keeps a hot key cheap.
    """
    d = F.col(date_col)
    cond = d <= F.lit(end) if lookback_start is None else d.between(F.lit(lookback_start), F.lit(end))
    if where is not None:
        cond = cond & where
    first = events.where(cond).groupBy(*keys).agg(F.min(date_col).alias("date"))
    return first.where(F.col("date") >= F.lit(start))


def enrolled_predecessors(account: DataFrame) -> DataFrame:
    """Ids whose enrolment timestamp is set (the 'previous owner had enrolled' set)."""
    return (account.where(F.col("enrolled_time_stamp__c").isNotNull())
            .select(F.col("dealership_id__c").alias("_prev_id")).distinct())


def without_enrolled_predecessor(account: DataFrame, prev_col: str = "previous_dealer_id__c") -> DataFrame:
    """Account rows whose previous-owner dealer is absent or never enrolled (anti join)."""
    prev = enrolled_predecessors(account)
    return account.join(prev, F.col(prev_col) == prev._prev_id, "left_anti")


def enrolled_in_window(account: DataFrame, start: dt.date, end: dt.date, tier: str | None = None,
                       vertical: str = "Powersports") -> DataFrame:
    """Dealers enrolled in [start, end] whose previous owner was not enrolled.

    The window is compared on the enrolment timestamp, so the end day only
    counts at midnight (closed range of timestamps, as written).
    """
    rows = without_enrolled_predecessor(account)
    cond = ((F.col("vertical_type__c") == vertical)
            & F.col("enrolled_time_stamp__c").between(F.lit(start), F.lit(end)))
    if tier is not None:
        cond = cond & tier_prefix("powersports_sales_tier__c", tier)
    return rows.where(cond).select(
        F.col("rsm_territory_regions__c").alias("region"),
        F.col("dealership_id__c").alias("dealership_id"),
        to_date_col("enrolled_time_stamp__c").alias("date"))


def status_level_up(status: DataFrame, account: DataFrame, dates: Sequence[dt.date],
                    top_levels: Sequence[str] = TOP_LEVELS) -> DataFrame:
    """Dealers whose monthly state entered a top level, dated one month less a day after the snapshot."""
    rows = status.where(to_date_col("partition_date").isin(list(dates))).withColumn(
        "OP_levelup_ind", level_up("full_status", "full_status_prior", top_levels))
    rows = rows.where(F.col("OP_levelup_ind") == 1)
    acc = account.select(F.col("dealership_id__c").alias("_id"),
                         F.col("rsm_territory_regions__c").alias("region"))
    return rows.join(acc, rows.dealership_id__c == acc._id, "left").select(
        "region", F.col("dealership_id__c").alias("dealership_id"),
        month_later("partition_date").alias("date"), "OP_levelup_ind")


def feature_enrolled_in_window(account: DataFrame, start: dt.date, end: dt.date,
                               vertical: str = "Powersports") -> DataFrame:
    """Dealers whose feature enrolment date falls in [start, end]."""
    enrolled = to_date_col("prequal_integrated_enrolled_date__c")
    return account.where(
        (F.col("vertical_type__c") == vertical)
        & F.col("prequal_integrated_enrolled_date__c").isNotNull()
        & enrolled.between(F.lit(start), F.lit(end))).select(
        F.col("rsm_territory_regions__c").alias("region"),
        F.col("dealership_id__c").alias("dealership_id"), enrolled.alias("date"))


def _nth_row_day(ladder: DataFrame, n: int, date_col: str) -> Column:
    """The day holding the n-th row of its dealer-month (NULL on other days)."""
    hit = (F.col("_rows_before") < n) & (F.col("_rows_through") >= n)
    return F.when(hit, F.col(date_col))


def new_threshold_vs_history(fact: DataFrame, n: int, lookback_start: dt.date, start: dt.date,
                             end: dt.date, region_col: str = "rsm_territory_regions__c") -> DataFrame:
    """New n+ dealer: no month since lookback reached n before ``start``, one does after.

    Per (region, dealer): ``date`` = day of the n-th row in a month on or
    after ``start``; ``prior_max_fund`` / ``curr_max_fund`` = best month totals
    before / from ``start``.  Row count (n-th row) and month total (sum of
    ``count``) are distinct measures, as in the source program.
    """
    days = funded_days(fact, lookback_start, end, region_col)
    return new_threshold_vs_history_days(days, n, lookback_start, start, end)


def new_threshold_vs_history_days(days: DataFrame, n: int, lookback_start: dt.date,
                                  start: dt.date, end: dt.date) -> DataFrame:
    """``new_threshold_vs_history`` over ``funded_days`` rows."""
    ladder = _ladder(days.where(_in_window(lookback_start, end)))
    after = F.col("funding_pending_date") >= F.lit(start)
    out = ladder.groupBy("region", "dealership_id").agg(
        F.min(F.when(after, _nth_row_day(ladder, n, "funding_pending_date"))).alias("date"),
        F.max(F.when(~after, F.col("_units_total")).otherwise(0)).alias("prior_max_fund"),
        F.max(F.when(after, F.col("_units_total")).otherwise(0)).alias("curr_max_fund"))
    return out.where((F.col("prior_max_fund") < n) & (F.col("curr_max_fund") >= n))


def nth_event_after_enrolment(fact: DataFrame, account: DataFrame, n: int, start: dt.date,
                              end: dt.date, enrol_floor: dt.date,
                              region_col: str = "rsm_territory_regions__c") -> DataFrame:
    """Newly enrolled dealers (no enrolled predecessor) reaching their n-th funded row in a month.

    Per (region, dealer): the earliest day holding the n-th row of one of
    its months in [start, end]; one region holds the n-th row of a month.
    """
    days = funded_days(fact, start, end, region_col)
    return nth_event_after_enrolment_days(days, account, n, start, end, enrol_floor)


def nth_event_after_enrolment_days(days: DataFrame, account: DataFrame, n: int, start: dt.date,
                                   end: dt.date, enrol_floor: dt.date) -> DataFrame:
    """``nth_event_after_enrolment`` over ``funded_days`` rows."""
    acc = (without_enrolled_predecessor(account)
           .where(F.col("enrolled_time_stamp__c") >= F.lit(enrol_floor))
           .select(F.col("dealership_id__c").alias("_acc_id")))
    rows = days.where(_in_window(start, end))
    rows = rows.join(acc, rows.dealership_id == acc._acc_id, "left_semi")
    ladder = _ladder(rows)
    nth = ladder.where((F.col("_rows_before") < n) & (F.col("_rows_through") >= n))
    return nth.groupBy("region", "dealership_id").agg(F.min("funding_pending_date").alias("date"))


def first_funding_in_window_days(days: DataFrame, start: dt.date, end: dt.date,
                                 lookback_start: dt.date) -> DataFrame:
    """First funded qualifying day since ``lookback_start`` falls in [start, end] (over day rows)."""
    return first_event_in_window(days, start, end, "funding_pending_date",
                                 lookback_start=lookback_start)


def first_applications(apps: DataFrame, end: dt.date, lookback_start: dt.date, flex_client: str,
                       app_types: Sequence[str] = DEALER_APP_TYPES,
                       excluded_classes: Sequence[str] = EXCLUDED_VEHICLE_CLASSES) -> DataFrame:
    """First application dates per (region, dealer) up to ``end``: one row instead of the applications.

    ``first_flex``: of the flex client, qualifying vehicle class, ever; ``first_dealer``: of a
    dealer type since ``lookback_start``; ``first_dealer_class``: the same of a qualifying class.
    """
    d = F.col("submitted_at")
    qualifying = vehicle_class_filter(excluded=excluded_classes)
    flex = (F.col("source_client") == flex_client) & qualifying
    dealer = (d >= F.lit(lookback_start)) & F.col("app_type").isin(list(app_types))
    return (apps.where((d <= F.lit(end)) & (flex | dealer))
            .groupBy(F.col("rsm_territory_regions__c").alias("region"), "dealership_id")
            .agg(F.min(F.when(flex, d)).alias("first_flex"), F.min(F.when(dealer, d)).alias("first_dealer"),
                 F.min(F.when(dealer & qualifying, d)).alias("first_dealer_class")))


def dealer_apps_from_firsts(firsts: DataFrame, account: DataFrame, start: dt.date, tier: str,
                            vehicle_filter: bool) -> DataFrame:
    """``dealer_apps`` over ``first_applications`` rows."""
    of = "first_dealer_class" if vehicle_filter else "first_dealer"
    first = firsts.groupBy("dealership_id").agg(F.min(of).alias("date")).where(F.col("date") >= F.lit(start))
    return _with_tier_region(first, account, tier)


def _with_tier_region(first: DataFrame, account: DataFrame, tier: str) -> DataFrame:
    acc = (account.where(tier_prefix("powersports_sales_tier__c", tier))
           .select(F.col("dealership_id__c").alias("_id"),
                   F.col("rsm_territory_regions__c").alias("region")))
    return first.join(acc, first.dealership_id == acc._id).select("region", "dealership_id", "date")


def dealer_apps(apps: DataFrame, account: DataFrame, start: dt.date, end: dt.date,
                lookback_start: dt.date, tier: str, vehicle_filter: bool,
                app_types: Sequence[str] = DEALER_APP_TYPES) -> DataFrame:
    """New active dealer of a tier: first dealer-type application since lookback is in the window.

    Region comes from the account.  The tier test is per dealer, so the first
    application is taken per dealer first (partial aggregate: one row per
    dealer crosses the network) and only then joined to the account.
    """
    where = F.col("app_type").isin(list(app_types))
    if vehicle_filter:
        where = where & vehicle_class_filter()
    first = first_event_in_window(apps, start, end, "submitted_at", keys=("dealership_id",),
                                  lookback_start=lookback_start, where=where)
    return _with_tier_region(first, account, tier)
