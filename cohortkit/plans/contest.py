"""Sales-contest dashboard: 11 qualifying-event metrics -> priced ledger -> running points.

Each metric is a spec (team, id, name, builder); builders are operators from
``cohortkit.operators.events`` with the contest's dates and thresholds.  The
stacked ledger is attributed to reps (broadcast lookup), hand-reported rows
are added, rows without a rep or after the end are dropped before the
running total, then points, names and milestones are attached.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.dates import year_before
from cohortkit.functions.predicates import EXCLUDED_VEHICLE_CLASSES, TOP_LEVELS
from cohortkit.operators import events as E
from cohortkit.operators import ledger as L
from cohortkit.sources.contracts import require_unique


@dataclass(frozen=True)
class ContestParams:
    start: dt.date
    end: dt.date
    lookback_start: dt.date                      # "no activity since" floor
    enrol_floor: dt.date                         # enrolment floor of the enrolment-to-E5+ metric
    level_dates: Sequence[dt.date]               # monthly status snapshots inside the contest
    feature_window: tuple[dt.date, dt.date] | None = None   # default: (start, end)
    yoy_n: int = 5
    history_n: int = 3
    nth_n: int = 5
    rep_region_overrides: Mapping[str, str] = field(default_factory=dict)
    excluded_reps: Sequence[str] = ()
    milestones: Mapping[str, int] = field(default_factory=lambda: dict(L.MILESTONES))
    flex_client: str = "direct_to_consumer_flex"
    app_types: Sequence[str] = E.DEALER_APP_TYPES
    vertical: str = "Powersports"
    top_levels: Sequence[str] = TOP_LEVELS
    excluded_classes: Sequence[str] = EXCLUDED_VEHICLE_CLASSES


@dataclass(frozen=True)
class Sources:
    fact: DataFrame            # funded applications
    apps: DataFrame            # all applications
    account: DataFrame
    status: DataFrame          # monthly loyalty status
    region_rep: DataFrame
    manual_report: DataFrame
    bounty: DataFrame
    # funded qualifying fact rows combined per (region, dealer, day); see ``narrow_sources``
    fact_days: DataFrame | None = None
    # first application dates per (region, dealer); see ``narrow_sources``
    app_firsts: DataFrame | None = None

    def days(self, lo: dt.date, p: ContestParams) -> DataFrame:
        return self.fact_days if self.fact_days is not None else E.funded_days(
            self.fact, lo, p.end, excluded_classes=p.excluded_classes)

    def firsts(self, p: ContestParams) -> DataFrame:
        return self.app_firsts if self.app_firsts is not None else E.first_applications(
            self.apps, p.end, p.lookback_start, p.flex_client, p.app_types, p.excluded_classes)


@dataclass(frozen=True)
class MetricSpec:
    team: str
    metric_id: int
    metric_name: str
    build: Callable[[Sources, ContestParams], DataFrame]


def m_new_e5_a_dealer(s: Sources, p: ContestParams) -> DataFrame:
    days = s.days(year_before(p.start), p)
    return E.yoy_new_threshold_days(days, s.account, p.yoy_n, p.start, p.end, tier="A")


def m_flex_dealer(s: Sources, p: ContestParams) -> DataFrame:
    return s.firsts(p).where(F.col("first_flex") >= F.lit(p.start)).select(
        "region", "dealership_id", F.col("first_flex").alias("date"))


def m_new_active_a_dealer(s: Sources, p: ContestParams) -> DataFrame:
    return E.dealer_apps_from_firsts(s.firsts(p), s.account, p.start, "A", vehicle_filter=False)


def m_a_dealer_enrolment(s: Sources, p: ContestParams) -> DataFrame:
    return E.enrolled_in_window(s.account, p.start, p.end, tier="A", vertical=p.vertical)


def m_enrolment(s: Sources, p: ContestParams) -> DataFrame:
    return E.enrolled_in_window(s.account, p.start, p.end, vertical=p.vertical)


def m_new_e1(s: Sources, p: ContestParams) -> DataFrame:
    days = s.days(p.lookback_start, p)
    return E.first_funding_in_window_days(days, p.start, p.end, p.lookback_start)


def m_level_up(s: Sources, p: ContestParams) -> DataFrame:
    return E.status_level_up(s.status, s.account, p.level_dates, p.top_levels)


def m_feature_integration(s: Sources, p: ContestParams) -> DataFrame:
    lo, hi = p.feature_window or (p.start, p.end)
    return E.feature_enrolled_in_window(s.account, lo, hi, p.vertical)


def m_new_e3(s: Sources, p: ContestParams) -> DataFrame:
    days = s.days(p.lookback_start, p)
    return E.new_threshold_vs_history_days(days, p.history_n, p.lookback_start, p.start, p.end)


def m_enrolment_to_e5(s: Sources, p: ContestParams) -> DataFrame:
    days = s.days(p.start, p)
    return E.nth_event_after_enrolment_days(days, s.account, p.nth_n, p.start, p.end, p.enrol_floor)


def m_new_active_b_dealer(s: Sources, p: ContestParams) -> DataFrame:
    return E.dealer_apps_from_firsts(s.firsts(p), s.account, p.start, "B", vehicle_filter=True)


# Team, metric id and metric name of every contest metric.
METRICS: tuple[MetricSpec, ...] = (
    MetricSpec("BDR", 2, "Enrollment", m_enrolment),
    MetricSpec("BDR", 3, "New E1+", m_new_e1),
    MetricSpec("BDR", 4, "OP Level Up", m_level_up),
    MetricSpec("BDR", 5, "Prequal Integration", m_feature_integration),
    MetricSpec("BDR", 6, "New E3+", m_new_e3),
    MetricSpec("BDR", 7, "Enrollment to E5+", m_enrolment_to_e5),
    MetricSpec("BDR", 9, "New Active B-Dealer", m_new_active_b_dealer),
    MetricSpec("RSM", 4, "Active Flex Dealer", m_flex_dealer),
    MetricSpec("RSM", 5, "New Active A-Dealer", m_new_active_a_dealer),
    MetricSpec("RSM", 6, "A-Dealer Enrollment", m_a_dealer_enrolment),
    MetricSpec("RSM", 7, "New E5+ A-Dealer", m_new_e5_a_dealer),
)


def narrow_sources(s: Sources, p: ContestParams, persist: bool = True) -> Sources:
    """One filtered, reduced slice per large source, shared by all built-in metrics.

    Every fact metric uses funded rows (case-sensitive) of a qualifying
    vehicle class dated between the earliest look-back and the contest end;
    they are read once (filters reach the parquet scan and prune date
    partitions) and combined per (region, dealer, day) -- the four fact
    metrics are answered from these day rows, each applying its own date
    window before its running totals.  The three application metrics need
    minima only, so the applications are reduced to first dates per (region,
    dealer).  No fact or application row is kept; the reduced slices, the
    contest's status rows and the account dimension are persisted.
    """
    lo = min(p.lookback_start, year_before(p.start))
    days = E.funded_days(s.fact, lo, p.end, excluded_classes=p.excluded_classes)
    firsts = E.first_applications(s.apps, p.end, p.lookback_start, p.flex_client, p.app_types, p.excluded_classes)
    status = s.status.where(F.col("partition_date").isin(list(p.level_dates)))
    account = s.account
    if persist:
        days, firsts, status, account = (x.persist(StorageLevel.MEMORY_AND_DISK)
                                         for x in (days, firsts, status, account))
    return Sources(s.fact, s.apps, account, status, s.region_rep, s.manual_report, s.bounty, days, firsts)


def metric_ledger(s: Sources, p: ContestParams,
                  metrics: Sequence[MetricSpec] = METRICS) -> DataFrame:
    return L.event_ledger([L.stamp_metric(m.build(s, p), m.team, m.metric_id, m.metric_name)
                           for m in metrics])


def attributed_rows(s: Sources, p: ContestParams, metrics: Sequence[MetricSpec] = METRICS) -> DataFrame:
    """BI rows attributed to reps, plus hand-reported rows (before the rep/date filter)."""
    bi = L.attribute_to_rep(metric_ledger(s, p, metrics), s.region_rep, p.rep_region_overrides)
    manual = L.manual_event_rows(s.manual_report, s.region_rep, p.excluded_reps,
                                 p.rep_region_overrides)
    return bi.unionByName(manual)


def priced_rows(s: Sources, p: ContestParams, metrics: Sequence[MetricSpec] = METRICS) -> DataFrame:
    rows = L.contest_rows(attributed_rows(s, p, metrics), p.end)
    return L.volume_flags(L.attach_dealer_name(L.price_events(rows, s.bounty), s.account))


def validate_sources(s: Sources, p: ContestParams) -> None:
    """Fail loudly on inputs the dashboard's joins assume unique.

    A rep with several regions would have each hand-reported row counted
    once per region; a repeated dealer id would repeat its events.
    """
    L.assert_unique_reps(s.region_rep, p.excluded_reps)
    require_unique(s.account, ["dealership_id__c"], "account")


def contest_dashboard(s: Sources, p: ContestParams, metrics: Sequence[MetricSpec] = METRICS,
                      narrow: bool | None = None, validate: bool = False,
                      kept: list[DataFrame] | None = None) -> DataFrame:
    """The 20-column dashboard: one row per qualifying event with running points and milestones.

    ``narrow`` (default: on for the built-in metrics) reads each large source
    once through ``narrow_sources``; custom metrics may need rows outside
    those slices, so it defaults to off for them.  ``validate`` runs
    ``validate_sources`` first.  Relations persisted on the way are appended
    to ``kept`` (when given) so the caller can release them after writing.
    """
    if validate:
        validate_sources(s, p)
    if narrow if narrow is not None else all(m in METRICS for m in metrics):
        s = narrow_sources(s, p)
        if kept is not None:
            kept.extend((s.fact_days, s.app_firsts, s.status, s.account))
    rows = ranked_rows(s, p, metrics, kept)
    return L.milestone_dates(rows, p.milestones).select(*L.DASHBOARD_COLUMNS, *p.milestones)


def ranked_rows(s: Sources, p: ContestParams, metrics: Sequence[MetricSpec] = METRICS,
                kept: list[DataFrame] | None = None) -> DataFrame:
    """Priced rows with running points.  The priced rows are read once, by the first step of the running total."""
    return L.running_points(priced_rows(s, p, metrics), kept=kept)
