"""Registered queries: each operator run on the test-data source views.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; ``__spark_entry__``
exposes this dict to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.predicates import tier_label, vehicle_class_filter
from cohortkit.operators import events as ev
from cohortkit.operators import ledger as led
from cohortkit.operators import panel as panel_ops
from cohortkit.operators import snapshots as snap
from cohortkit.operators.cohorts import candidate_counts
from cohortkit.operators.first_dates import FirstDates, first_in_window
from cohortkit.operators.matching import match_cell_counts
from cohortkit.operators.sink import write_result
from cohortkit.plans import contest as ct
from cohortkit.plans.lift_report import lift_stages
from cohortkit.session import shared_folder
from cohortkit.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
# what the last registered query keeps persisted; the next one releases it
_STAGES: list = []
_KEPT: list[DataFrame] = []


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- activity snapshots -----------------------------------------------------

@register("a41_report_grid")
def q_report_grid(spark, sf):
    """The grid over the span of the history, a step of five months."""
    return snap.history_grid(td.user_hist(spark, sf), 5)


@register("a43_activity_snapshots_history_grid")
def q_activity_snapshots_history(spark, sf):
    hist = td.user_hist(spark, sf)
    return snap.activity_snapshots(hist, snap.history_grid(hist, 5))


@register("a42_last_activity_by_type")
def q_last_activity(spark, sf):
    hist = td.user_hist(spark, sf)
    return snap.last_activity_by_type(hist, ["partition_date", "dealership_id"])


@register("a43_activity_snapshots")
def q_activity_snapshots(spark, sf):
    return snap.activity_snapshots_on_grid(td.user_hist(spark, sf), td.GRID_FIRST,
                                           td.GRID_LAST, td.GRID_STEP)


@register("a43_activity_snapshots_step2")
def q_activity_snapshots_step2(spark, sf):
    return snap.activity_snapshots_on_grid(td.user_hist(spark, sf), td.GRID_FIRST,
                                           td.GRID_LAST, 2)


@register("a44_write_result")
def q_write_result(spark, sf):
    """Snapshots written by report date; one date is written again; the table as read back."""
    out = f"{shared_folder(spark)}/a44-{uuid.uuid4().hex[:12]}"
    snaps = q_activity_snapshots(spark, sf)
    write_result(snaps, out, partition_by=["Report_Date"])
    write_result(q_activity_snapshots(spark, sf).where(F.col("Report_Date") == F.lit(td.GRID_FIRST)), out,
                 partition_by=["Report_Date"])
    return spark.read.parquet(out).select(*snaps.columns)


def _database(spark) -> str:
    """A database of its own in the shared folder."""
    name = f"cohortkit_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    return name


@register("a44_replace_table")
def q_replace_table(spark, sf):
    """A catalog table of all snapshots, replaced by what is computed from itself: its report dates from 1998 on."""
    table = f"{_database(spark)}.snapshots"
    write_result(q_activity_snapshots(spark, sf), table=table)
    write_result(spark.table(table).where("Report_Date >= date'1998-01-01'"), table=table)
    return spark.table(table)


@register("a44_append_table")
def q_append_table(spark, sf):
    """A catalog table of the snapshots before 1998, appended to by those from then on."""
    table = f"{_database(spark)}.snapshots"
    snaps = q_activity_snapshots(spark, sf)
    write_result(snaps.where("Report_Date < date'1998-01-01'"), table=table)
    write_result(snaps.where("Report_Date >= date'1998-01-01'"), table=table, mode="append")
    return spark.table(table)


# --- peer lift report -------------------------------------------------------


# The sf0.01 fixture has no dealer above 10 first-pass peers; the registered
# matching queries lower the thresholds so every branch of the rule runs.
SMALL_LOW, SMALL_HIGH = 2, 3


def _stages(spark, sf, **kw):
    for earlier in _STAGES:
        earlier.release()
    _STAGES[:] = [lift_stages(td.fact_funded(spark, sf), td.dim_account(spark, sf), td.AS_OF, **kw)]
    return _STAGES[0]


def _money(df, *cols):
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


@register("a01_month_spine")
def q_spine(spark, sf):
    return _stages(spark, sf, all_time=True).spine


@register("a02_enrolment_cohorts")
def q_cohorts(spark, sf):
    return _stages(spark, sf).cohorts


@register("a03_monthly_measures")
def q_monthly(spark, sf):
    return _money(_stages(spark, sf, all_time=True).monthly, "Orig")


@register("a04_cohort_baseline")
def q_baseline(spark, sf):
    return _money(_stages(spark, sf).baseline, "Orig")


@register("a05_growth_profile")
def q_profile(spark, sf):
    return _money(_stages(spark, sf).profile, "M0_Orig")


@register("a08_candidate_profiles")
def q_candidates(spark, sf):
    return _money(_stages(spark, sf).candidates, "M0_Orig")


@register("a08_candidate_counts")
def q_candidate_counts(spark, sf):
    st = _stages(spark, sf, all_time=True)
    return candidate_counts(st.candidates, st.cohorts, st.pool)


@register("a09_never_enrolled")
def q_never_enrolled(spark, sf):
    return _stages(spark, sf, all_time=True).pool


@register("a10_match_cells")
def q_match_cells(spark, sf):
    """Every treated dealer against every candidate of its M0, counted by cells, unmatched dealers included."""
    st = _stages(spark, sf, all_time=True)
    return match_cell_counts(st.profile, st.candidates, st.pool)


_PAIR_COLS = ["M0", "dealership_id__c", "Peer_Dealership_id", "within_M0_Fund_Ind",
              "within_MP1_Fund_MoM_1", "within_MP1_Fund_MoM_2L", "within_MP1_Fund_MoM_2H",
              "Peer_Sel_1_Ind"]


@register("a10_match_flags")
def q_match(spark, sf):
    return _stages(spark, sf).pairs.select(*_PAIR_COLS)


@register("a11_adaptive_peers")
def q_adaptive(spark, sf):
    return _stages(spark, sf).adaptive.select(
        *_PAIR_COLS, "Peer_Cnt_Sel_1", "Peer_Sel_2_Ind", "Peer_Cnt_Final")


@register("a11_adaptive_peers_low_thresholds")
def q_adaptive_small(spark, sf):
    return _stages(spark, sf, low=SMALL_LOW, high=SMALL_HIGH).adaptive.select(
        *_PAIR_COLS, "Peer_Cnt_Sel_1", "Peer_Sel_2_Ind", "Peer_Cnt_Final")


@register("a12_peer_normaliser")
def q_normaliser(spark, sf):
    return _money(_stages(spark, sf).normaliser, "M0_Orig", "Peer_tot_M0_Orig")


@register("a13_peer_monthly")
def q_peer_monthly(spark, sf):
    return _money(_stages(spark, sf).peer_months, "Orig_Amt")


@register("a14_synthetic_peer")
def q_synthetic(spark, sf):
    return _money(_stages(spark, sf).synthetic, "Orig")


@register("a15_dense_panel")
def q_panel(spark, sf):
    return _stages(spark, sf).panel


@register("a16_fill_panel")
def q_fill(spark, sf):
    return _money(_stages(spark, sf).filled, "Orig_amt")


@register("a17_cohort_sizes")
def q_sizes(spark, sf):
    return _stages(spark, sf).sizes


@register("a18_lift_panel")
def q_lift_panel(spark, sf):
    lp = _stages(spark, sf).lift_panel
    return _money(lp.select("M0", "M0_PrequalD_Cnt", "M0_PrequalD_wPeer_Cnt", "dealership_id__c",
                            "w_Peer_Ind", "Peer_Cnt", "Calendar_MM", "MM", "Funded_app",
                            "Orig_amt", "Norm_Funded", "Norm_Orig"), "Orig_amt")


@register("a19_cohort_tenure")
def q_tenure(spark, sf):
    return _stages(spark, sf).tenure


@register("a20_tier_label")
def q_tier(spark, sf):
    acc = td.dim_account(spark, sf)
    return acc.select("dealership_id__c", tier_label("powersports_sales_tier__c").alias("Dealership_Tier"))


@register("a21_peer_lift_report")
def q_lift_report(spark, sf):
    return _stages(spark, sf).report


@register("a21_peer_lift_report_low_thresholds")
def q_lift_report_small(spark, sf):
    return _stages(spark, sf, low=SMALL_LOW, high=SMALL_HIGH).report


@register("a22_lift")
def q_lift(spark, sf):
    return panel_ops.lift(_stages(spark, sf).lift_panel)


# --- sales contest ----------------------------------------------------------


CONTEST = ct.ContestParams(
    start=td.CONTEST_START, end=td.CONTEST_END, lookback_start=td.LOOKBACK_START,
    enrol_floor=td.ENROL_FLOOR, level_dates=td.LEVEL_DATES,
    rep_region_overrides=td.REP_REGION_OVERRIDES, excluded_reps=td.EXCLUDED_REPS)
# the feature-enrolment metric has no event in the contest window at sf0.01
CONTEST_WIDE_FEATURE = ct.ContestParams(**{**CONTEST.__dict__, "feature_window": td.FEATURE_WINDOW_WIDE})


def _contest_sources(spark, sf, narrow: bool = True) -> ct.Sources:
    s = ct.Sources(td.fact_funded(spark, sf), td.fact_apps(spark, sf), td.dim_account(spark, sf),
                   td.status_monthly(spark, sf), td.region_rep(spark, sf),
                   td.manual_report(spark, sf), td.bounty(spark, sf))
    if not narrow:
        return s
    # every registered contest query uses the built-in metrics, whose rows the slices hold
    s = ct.narrow_sources(s, CONTEST)
    _fresh().extend((s.fact_days, s.app_firsts, s.status, s.account))
    return s


def _fresh() -> list[DataFrame]:
    for df in _KEPT:
        df.unpersist()
    _KEPT.clear()
    return _KEPT


def _spec(team, metric_id):
    return next(m for m in ct.METRICS if m.team == team and m.metric_id == metric_id)


def _metric(team, metric_id, params=CONTEST):
    def q(spark, sf):
        df = _spec(team, metric_id).build(_contest_sources(spark, sf), params)
        return df.select("region", "dealership_id", "date")
    return q


@register("a23_vehicle_class_filter")
def q_vehicle(spark, sf):
    fact = td.fact_funded(spark, sf)
    return fact.where(vehicle_class_filter()).select("dealership_id", "funding_pending_date", "vehicle_type")


@register("a24_yoy_new_threshold")
def q_yoy(spark, sf):
    s = _contest_sources(spark, sf)
    return ev.yoy_new_threshold(s.fact, s.account, CONTEST.yoy_n, CONTEST.start, CONTEST.end, tier="A")


@register("a25_cumulative_threshold_date")
def q_cum_threshold(spark, sf):
    rows = ev.funded_rows(td.fact_funded(spark, sf), None, td.AS_OF)
    return ev.cumulative_threshold_date(rows, 5)


REGISTRY["a26_first_event_flex"] = _metric("RSM", 4)
REGISTRY["a26_first_event_new_active_a"] = _metric("RSM", 5)
REGISTRY["a26_first_event_funding"] = _metric("BDR", 3)
REGISTRY["a26_first_event_new_active_b"] = _metric("BDR", 9)
REGISTRY["a27_enrolled_in_window"] = _metric("BDR", 2)
REGISTRY["a27_enrolled_in_window_a_tier"] = _metric("RSM", 6)
REGISTRY["a28_status_level_up"] = _metric("BDR", 4)
REGISTRY["a29_feature_enrolled_in_window"] = _metric("BDR", 5, CONTEST_WIDE_FEATURE)


@register("a30_new_threshold_vs_history")
def q_history(spark, sf):
    s = _contest_sources(spark, sf)
    return ev.new_threshold_vs_history(s.fact, CONTEST.history_n, CONTEST.lookback_start,
                                       CONTEST.start, CONTEST.end)


REGISTRY["a31_nth_event_after_enrolment"] = _metric("BDR", 7)


@register("a32_event_ledger")
def q_ledger(spark, sf):
    return ct.metric_ledger(_contest_sources(spark, sf), CONTEST)


@register("a33_attribute_to_rep")
def q_attribute(spark, sf):
    s = _contest_sources(spark, sf)
    return led.attribute_to_rep(ct.metric_ledger(s, CONTEST), s.region_rep, CONTEST.rep_region_overrides)


@register("a34_manual_event_rows")
def q_manual(spark, sf):
    s = _contest_sources(spark, sf)
    return led.manual_event_rows(s.manual_report, s.region_rep, CONTEST.excluded_reps,
                                 CONTEST.rep_region_overrides)


@register("a35_price_events")
def q_price(spark, sf):
    s = _contest_sources(spark, sf)
    rows = led.contest_rows(ct.attributed_rows(s, CONTEST), CONTEST.end)
    return led.price_events(rows, s.bounty)


@register("a36_attach_dealer_name")
def q_names(spark, sf):
    s = _contest_sources(spark, sf)
    rows = led.contest_rows(ct.attributed_rows(s, CONTEST), CONTEST.end)
    return led.attach_dealer_name(rows, s.account)


@register("a37_volume_flags")
def q_flags(spark, sf):
    s = _contest_sources(spark, sf)
    return led.volume_flags(ct.attributed_rows(s, CONTEST))


@register("a38_running_points")
def q_running(spark, sf):
    return ct.ranked_rows(_contest_sources(spark, sf), CONTEST, kept=_KEPT)


@register("a39_milestone_first_reach")
def q_first_reach(spark, sf):
    rows = ct.ranked_rows(_contest_sources(spark, sf), CONTEST, kept=_KEPT)
    return led.first_reach(led.milestone_dates(rows))


@register("a40_contest_dashboard")
def q_dashboard(spark, sf):
    return ct.contest_dashboard(_contest_sources(spark, sf, narrow=False), CONTEST, kept=_fresh())


@register("a40_contest_dashboard_wide_feature")
def q_dashboard_wide(spark, sf):
    return ct.contest_dashboard(_contest_sources(spark, sf, narrow=False), CONTEST_WIDE_FEATURE, kept=_fresh())


@register("a45_first_n_to_reach")
def q_first_n(spark, sf):
    rows = ct.ranked_rows(_contest_sources(spark, sf), CONTEST, kept=_KEPT)
    return led.first_n_to_reach(rows, 250000, 3)


@register("a26_first_event_dealer_apps")
def q_first_dealer_app(spark, sf):
    apps = td.fact_apps(spark, sf).withColumn("region", F.col("rsm_territory_regions__c"))
    return ev.first_event_in_window(apps, CONTEST.start, CONTEST.end, "submitted_at",
                                    lookback_start=CONTEST.lookback_start,
                                    where=F.col("app_type").isin(list(ev.DEALER_APP_TYPES)))


@register("a30_new_threshold_vs_history_n6")
def q_history_n6(spark, sf):
    s = _contest_sources(spark, sf)
    return ev.new_threshold_vs_history(s.fact, 6, CONTEST.lookback_start, CONTEST.start, CONTEST.end)


@register("a26_first_event_state")
def q_first_event_state(spark, sf):
    """Active flex dealers from a state of first dates, built by two updates: up to a month into the contest, and the rest."""
    apps = td.fact_apps(spark, sf).withColumn("region", F.col("rsm_territory_regions__c"))
    flex = (F.col("source_client") == CONTEST.flex_client) & vehicle_class_filter()
    state = FirstDates(spark, f"{shared_folder(spark)}/a26-{uuid.uuid4().hex[:12]}")
    for upto in (td.LEVEL_DATES[-1], CONTEST.end):
        state.update(apps, upto, "submitted_at", flex)
    return first_in_window(state.read(), CONTEST.start, CONTEST.end)


SHORT_LOOKBACK = td.dt.date(1998, 1, 1)


@register("a26_first_event_funding_short_lookback")
def q_first_funding_short(spark, sf):
    # the fixture's dealers fund every month since the contest look-back, so the BDR metric is
    # empty there; with a one-month look-back the same operator has rows to check
    days = ev.funded_days(td.fact_funded(spark, sf), SHORT_LOOKBACK, CONTEST.end)
    return ev.first_funding_in_window_days(days, CONTEST.start, CONTEST.end, SHORT_LOOKBACK)

