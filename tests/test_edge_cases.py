"""Inputs that the test tables never produce: ties, year ends, vacant territories, tables written twice."""

import datetime as dt
from dataclasses import replace

import pytest

from cohortkit.functions import month_later, year_before
from cohortkit.operators import events as E
from cohortkit.operators import ledger as L
from cohortkit.operators.sink import write_result
from cohortkit.plans import contest as ct
from cohortkit.plans.jobs import snapshots_job
from cohortkit.plans.registry import CONTEST, _contest_sources
from tests.conftest import SMOKE
from tests.fixtures import D, account_row, fact_row, frame

START, END = D(2024, 1, 1), D(2024, 1, 31)


def two_region_day(spark, east=3, west=2):
    day = D(2024, 1, 10)
    rows = [fact_row(1, day, region="EAST")] * east + [fact_row(1, day, region="WEST")] * west
    return frame(spark, "fact_funded", rows)


def test_the_nth_event_is_awarded_once_when_two_regions_share_the_day(spark):
    account = frame(spark, "dim_account", [account_row(1, enrolled_ts=dt.datetime(2024, 1, 2))])
    for n, region in ((3, "EAST"), (4, "WEST"), (5, "WEST")):
        got = E.nth_event_after_enrolment(two_region_day(spark), account, n, START, END, START).collect()
        assert [(r.region, r.dealership_id, r.date) for r in got] == [(region, 1, D(2024, 1, 10))]


def test_history_threshold_dates_one_region_only(spark):
    got = E.new_threshold_vs_history(two_region_day(spark), 5, D(2023, 1, 1), START, END).collect()
    assert sorted((r.region, r.date) for r in got) == [("EAST", None), ("WEST", D(2024, 1, 10))]


def test_yoy_lists_regions_from_the_crossing_on(spark):
    account = frame(spark, "dim_account", [account_row(1)])
    got = E.yoy_new_threshold(two_region_day(spark, 3, 3), account, 4, START, END).collect()
    assert sorted((r.region, r.date) for r in got) == [("EAST", None), ("WEST", D(2024, 1, 10))]


def test_yoy_window_over_a_year_end(spark):
    rows = [fact_row(1, D(2023, 1, 5 + i)) for i in range(6)] + [fact_row(2, D(2024, 1, 5 + i)) for i in range(6)]
    rows += [fact_row(3, D(2023, 12, 5 + i)) for i in range(6)] + [fact_row(4, D(2022, 12, 5 + i)) for i in range(6)]
    rows += [fact_row(5, D(2023, 12, 5 + i)) for i in range(6)] + [fact_row(5, D(2022, 12, 5 + i)) for i in range(6)]
    account = frame(spark, "dim_account", [account_row(i) for i in range(1, 6)])
    got = E.yoy_new_threshold(frame(spark, "fact_funded", rows), account, 5, D(2023, 12, 1), D(2024, 1, 31)).collect()
    assert sorted((r.dealership_id, r.mm, r.date) for r in got) == [(2, 1, D(2024, 1, 9)), (3, 12, D(2023, 12, 9))]


def test_yoy_prior_month_keeps_the_29th_of_february(spark):
    assert year_before(D(2025, 2, 28)) == D(2024, 2, 29) and year_before(D(2024, 2, 29)) == D(2023, 2, 28)
    assert year_before(D(2025, 2, 27)) == D(2024, 2, 27)
    rows = [fact_row(1, D(2024, 2, 29))] * 5 + [fact_row(1, D(2025, 2, 10))] * 5
    account = frame(spark, "dim_account", [account_row(1)])
    assert E.yoy_new_threshold(frame(spark, "fact_funded", rows), account, 5, D(2025, 2, 1), D(2025, 2, 28)).collect() == []


def test_level_up_of_a_snapshot_inside_the_month(spark):
    df = spark.createDataFrame([(D(2024, 2, 15),), (D(2024, 2, 1),), (D(2024, 1, 31),)], "d date")
    assert [r.x for r in df.select(month_later("d").alias("x")).collect()] == [D(2024, 3, 14), D(2024, 2, 29), D(2024, 2, 28)]


def test_new_active_b_dealer_reads_tier_class_and_lookback(spark):
    def app(dealer, day, vehicle="ATV", kind="Dealer"):
        return (dealer, day, "dealer_portal", vehicle, kind, "EAST")

    apps = frame(spark, "fact_apps", [
        app(1, D(2024, 1, 5)), app(2, D(2024, 1, 5)), app(3, D(2024, 1, 6), "RV"), app(3, D(2024, 1, 9)),
        app(4, D(2023, 12, 9)), app(4, D(2024, 1, 9)), app(5, D(2023, 5, 1)), app(5, D(2024, 1, 7), kind="lightspeed"),
        app(6, D(2024, 1, 8), kind="Consumer")])
    account = frame(spark, "dim_account", [account_row(i, tier="A1" if i == 2 else "B2", region="WEST") for i in range(1, 7)])
    args = (START, END, D(2023, 9, 1), "B", True)
    want = [("WEST", 1, D(2024, 1, 5)), ("WEST", 3, D(2024, 1, 9)), ("WEST", 5, D(2024, 1, 7))]
    assert sorted(map(tuple, E.dealer_apps(apps, account, *args).collect())) == want
    firsts = E.first_applications(apps, END, D(2023, 9, 1), "direct_to_consumer_flex")
    assert sorted(map(tuple, E.dealer_apps_from_firsts(firsts, account, START, "B", True).collect())) == want


def test_vacant_territories_are_no_rep_with_two_regions(spark):
    reps = frame(spark, "region_rep", [("EAST", "RSM", None), ("WEST", "RSM", None), ("NORTH", "RSM", "ann")])
    L.assert_unique_reps(reps)
    L.assert_unique_reps(reps, ["bob"])
    with pytest.raises(ValueError, match="ann"):
        L.assert_unique_reps(reps.union(frame(spark, "region_rep", [("SOUTH", "RSM", "ann")])))


def test_dashboard_with_other_milestones(spark):
    kept = []
    p = replace(CONTEST, milestones={"date_10K": 10_000, "date_2M": 2_000_000})
    dash = ct.contest_dashboard(_contest_sources(spark, SMOKE, narrow=False), p, kept=kept)
    assert dash.columns[-3:] == ["cum_sum", "date_10K", "date_2M"]
    assert dash.where("cum_sum >= 10000 and date_10K is null or cum_sum < 10000 and date_10K is not null").count() == 0
    for df in kept:
        df.unpersist()


def test_building_the_dashboard_runs_no_job_and_keeps_no_raw_rows(spark):
    kept = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building a plan")
    dash = ct.contest_dashboard(_contest_sources(spark, SMOKE, narrow=False), CONTEST, list(ct.METRICS), kept=kept)
    assert not tracker.getJobIdsForGroup("build") and dash.columns
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not any({"submitted_at", "total_financed"} & set(df.columns) for df in kept)
    assert len(kept) == 5 and all(df.is_cached for df in kept)
    for df in kept:
        df.unpersist()


def test_a_table_written_again_keeps_its_other_dates(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS sink_test LOCATION '" + str(tmp_path / "db") + "'")
    hist = spark.createDataFrame(
        [(D(2024, 1, 1), 1, dt.datetime(2023, 12, 30), "Default"), (D(2024, 2, 1), 1, dt.datetime(2024, 1, 30), "Default")],
        "partition_date date, dealership_id long, last_login timestamp_ntz, dealer_user_type string")
    hist.write.mode("overwrite").saveAsTable("sink_test.hist")
    snapshots_job(spark, "sink_test.hist", D(2024, 1, 1), D(2024, 2, 1), 1, "sink_test.snaps")
    first = sorted(map(tuple, spark.table("sink_test.snaps").collect()))
    assert len(first) == 2
    snaps = spark.createDataFrame(spark.table("sink_test.snaps").where("Report_Date = date'2024-02-01'").collect(),
                                  spark.table("sink_test.snaps").schema)
    write_result(snaps.select(*reversed(snaps.columns)), table="sink_test.snaps", partition_by=["Report_Date"])
    assert sorted(map(tuple, spark.table("sink_test.snaps").collect())) == first
    snapshots_job(spark, "sink_test.hist", D(2024, 1, 1), D(2024, 2, 1), 1, "sink_test.snaps")
    assert sorted(map(tuple, spark.table("sink_test.snaps").collect())) == first
    write_result(snaps, table="sink_test.snaps", mode="append", partition_by=["Report_Date"])
    assert spark.table("sink_test.snaps").count() == 3
    spark.sql("DROP DATABASE sink_test CASCADE")


def test_the_report_joins_cells_once_and_makes_selected_pairs_only(spark):
    """The cell join is planned once for the counts and once for the pick, on distinct cells; no band join of dealers."""
    from cohortkit.operators import matching as M
    from cohortkit.plans.registry import _stages

    stages = _stages(spark, SMOKE, low=2, high=3)
    cells = M.match_cells(stages.profile, stages.candidates)
    assert cells.count() == cells.select(*M.TREATED_CELL, *M.PEER_CELL).distinct().count()
    selected = sorted(map(tuple, stages.selected.collect()), key=str)
    assert selected == sorted(map(tuple, M.selected_peers(stages.adaptive).collect()), key=str)
    assert "pairs" in stages.__dict__  # only because the line above asked for them
    fresh = _stages(spark, SMOKE, low=2, high=3)
    fresh.report
    assert "pairs" not in fresh.__dict__ and "adaptive" not in fresh.__dict__
    fresh.release()
