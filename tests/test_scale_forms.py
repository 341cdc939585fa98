"""The forms that hold at volume: sums by cell, ranges of a running total, bounded scans, run-time pruning."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortkit.functions.dates import report_grid, report_grid_relation
from cohortkit.operators import ledger as L
from cohortkit.operators import matching as M
from cohortkit.operators.snapshots import activity_snapshots, history_grid
from cohortkit.plans.lift_report import lift_stages
from tests.fixtures import D, account_row, fact_row, frame, random_peer_world

AS_OF = D(2022, 1, 15)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ sums by cell

@pytest.mark.parametrize("low,high", [(4, 10), (2, 3)])
def test_sums_by_cell_equal_sums_by_pair(spark, low, high):
    facts, accounts, _ = random_peer_world()
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts), AS_OF, low=low, high=high)
    by_pair = M.peer_normaliser(st.profile, st.selected)
    columns = sorted(by_pair.columns)
    as_text = [F.col(c).cast("string") for c in columns]
    assert rows(st.normaliser.select(*as_text)) == rows(by_pair.select(*as_text))
    keys = ["M0", "dealership_id__c", "Funding_MM"]
    sums = st.peer_months.groupBy(*keys).agg(F.sum("Funded_Apps").alias("Funded"), F.sum("Orig_Amt").alias("Orig"))
    text = [F.col(c).cast("string") for c in (*keys, "Funded", "Orig")]
    assert rows(st.synthetic.select(*text)) == rows(sums.select(*text)) and st.synthetic.count() > 0
    st.release()


def test_the_report_makes_no_pair_of_dealers(spark):
    facts, accounts, _ = random_peer_world()
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts), AS_OF)
    assert st.report.columns
    assert not {"selected", "pairs", "adaptive", "peer_months"} & set(st.__dict__)
    assert "Peer_Dealership_id" not in st.cell_months.columns and "dealership_id__c" not in st.cell_months.columns
    st.release()


def test_many_dealers_of_one_cell_share_one_sum(spark):
    """300 treated dealers and 40 peers alike: one treated cell, one peer cell, 40 member rows, not 12,000 pairs."""
    facts, accounts = [], []
    for i in range(300):
        accounts.append(account_row(i, prequal=D(2021, 3, 5)))
        facts += [fact_row(i, D(2021, m, 2), count=10) for m in (2, 3)]
    for j in range(1000, 1040):
        facts += [fact_row(j, D(2021, m, 2), count=10, amount=f"{j}.00") for m in (2, 3, 4)]
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts), AS_OF)
    assert st.picked.count() == 1 and M.picked_members(st.candidates, st.picked).count() == 40
    assert {tuple(r) for r in st.normaliser.select("Peer_Cnt", "Peer_tot_M0_Fund").collect()} == {(40, 400)}
    april = st.report.where("Calendar_MM = date'2021-04-01'").select("Funding", "Funding_Peer").collect()
    assert len(april) == 300 and {tuple(r) for r in april} == {(0, 10.0)}
    st.release()


# ------------------------------------------------------------------ bounded scan

def test_the_fact_scan_starts_at_the_first_cohort(spark, tmp_path):
    facts, accounts, _ = random_peer_world()
    facts += [fact_row(5001, D(2015, m, 1)) for m in range(1, 13)]
    frame(spark, "fact_funded", facts).repartition(1).write.partitionBy("funding_pending_date").parquet(str(tmp_path / "fact"))
    stored, account = spark.read.parquet(str(tmp_path / "fact")), frame(spark, "dim_account", accounts)
    st = lift_stages(stored, account, AS_OF, persist=False, materialize=False)
    assert st.first_month == D(2021, 2, 1)
    filters = plan_of(st.activity).split("PartitionFilters: [")[1].split("]")[0]
    assert "funding_pending_date" in filters and ">= 2021-02-01" in filters
    whole = lift_stages(stored, account, AS_OF, all_time=True)
    assert rows(st.report) == rows(whole.report)
    assert whole.spine.count() > st.spine.count()
    whole.release()


def test_without_a_cohort_nothing_is_read(spark):
    facts, accounts, _ = random_peer_world()
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", [account_row(1)]), AS_OF)
    assert st.first_month is None and st.report.count() == 0
    st.release()


# ------------------------------------------------------------------ running points

def ledger(spark, events):
    schema = ("Report_Type string, sales_name string, team string, metric_id int, region string, dealership_id long, "
              "date date, note string, metric_volume long, bounty long")
    return spark.createDataFrame(events, schema).repartition(5)


def running(events):
    out, total = [], {}
    # NULL first, as in the library
    for e in sorted(events, key=lambda e: ((e[1] is not None, e[1] or ""), e[6], *[(x is not None, x if x is not None else 0)
                                           for x in (e[0], e[2], e[3], e[4], e[5], e[7], e[8], e[9])])):
        if e[9] is not None:
            total[e[1]] = total.get(e[1], 0) + e[9]
        out.append((*e, total.get(e[1])))
    return sorted(out, key=repr)


def test_one_rep_and_one_day_spread_over_all_ranges(spark, monkeypatch):
    """4,000 different notes and 9,001 copies of one row, all of one rep and day."""
    monkeypatch.setattr(L, "COPIES", 1000)
    rng = random.Random(3)
    events = [("Sales", "ann", "RSM", 8, None, 999, D(2024, 1, 5), f"n{i:05d}", 1, rng.choice([None, 5, 7, 100])) for i in range(4000)]
    events += [("Sales", "ann", "RSM", 8, None, 999, D(2024, 1, 5), "same", 1, 3)] * 9001
    rng.shuffle(events)
    kept = []
    got = L.running_points(ledger(spark, events), ranges=8, kept=kept)
    assert rows(got) == running(events)
    sizes = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1200  # 4,001 distinct rows over eight ranges
    assert "sales_name, date" not in "".join(line for line in plan_of(got).splitlines() if "Window [" in line and "_range" not in line)
    kept[0].unpersist()


def test_running_points_of_any_ranges(spark):
    rng = random.Random(9)
    events = [(rng.choice(["BI", "Sales"]), rng.choice(["ann", "bob", None, "cy"]), rng.choice(["RSM", None]), rng.choice([1, 2, None]),
               rng.choice(["W", None]), rng.choice([5, None]), D(2024, 1, rng.randint(1, 4)), rng.choice(["x", None, "y"]),
               rng.choice([1, 0, None]), rng.choice([None, 10, -3, 0])) for _ in range(700)]
    for n in (1, 3, 16):
        kept = []
        assert rows(L.running_points(ledger(spark, events), ranges=n, kept=kept)) == running(events)
        kept[0].unpersist()


# ------------------------------------------------------------------ the grid

def test_grid_relation_equals_the_loop(spark):
    rng = random.Random(5)
    cases = [(D(2021, 1, 31), D(2021, 9, 1), 1), (D(2024, 1, 31), D(2024, 1, 31), 3), (D(2024, 5, 1), D(2020, 1, 1), 2),
             (D(2020, 2, 29), D(2024, 2, 29), 12), (D(1995, 1, 1), D(2001, 8, 1), 1)]
    cases += [(first, first + dt.timedelta(days=rng.randint(-400, 2500)), rng.randint(1, 14)) for first in
              (D(2019, 1, 1) + dt.timedelta(days=rng.randint(0, 800)) for _ in range(60))]
    for step in sorted({c[2] for c in cases}):
        of_step = [c for c in cases if c[2] == step]
        for first, last, _ in of_step[:6]:
            bounds = spark.createDataFrame([(first, last)], "first date, last date")
            assert [r[0] for r in report_grid_relation(bounds, step).collect()] == report_grid(first, last, step), (first, last, step)
    many = spark.createDataFrame([c[:2] for c in cases] + [(None, D(2024, 1, 1)), (D(2024, 1, 1), None)], "first date, last date")
    assert report_grid_relation(many, 5).count() == sum(len(report_grid(a, b, 5)) for a, b, _ in cases)
    with pytest.raises(ValueError):
        report_grid_relation(many, 0)


def hist(spark, tmp_path):
    events = [(D(2021, 1, 1) + dt.timedelta(days=i), i % 7, dt.datetime(2020, 12, 1) + dt.timedelta(days=i // 2), "Default")
              for i in range(0, 400)]
    frame(spark, "user_hist", events).repartition(1).write.partitionBy("partition_date").parquet(str(tmp_path / "hist"))
    return spark.read.parquet(str(tmp_path / "hist")), events


def test_a_grid_from_data_prunes_partitions_when_it_runs(spark, tmp_path):
    stored, events = hist(spark, tmp_path)
    # a join's pruning filter is planned where the history is large next to the grid
    grid = history_grid(stored, 3)
    snaps = activity_snapshots(stored, grid)
    assert "dynamicpruning" in plan_of(snaps)
    days = report_grid(D(2021, 1, 1), events[-1][0], 3)
    assert rows(snaps) == rows(activity_snapshots(frame(spark, "user_hist", events), days))
    assert {r.Report_Date for r in snaps.collect()} == {d for d in days if d <= events[-1][0]}


def test_a_date_given_twice_is_one_report(spark, tmp_path):
    stored, events = hist(spark, tmp_path)
    assert rows(activity_snapshots(stored, [D(2021, 1, 1)] * 2)) == rows(activity_snapshots(stored, [D(2021, 1, 1)]))
    assert activity_snapshots(stored, []).count() == 0
