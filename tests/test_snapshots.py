import datetime as dt

from cohortkit.functions.dates import report_grid
from cohortkit.operators.sink import write_result
from cohortkit.operators.snapshots import activity_snapshots
from tests.fixtures import D, frame

TS = dt.datetime


def hist(spark):
    rows = [(D(2021, 1, 1), 1, TS(2020, 12, 30, 9), "Default"),
            (D(2021, 1, 1), 1, TS(2020, 12, 20, 9), "ADMINISTRATOR"),
            (D(2021, 1, 1), 1, TS(2020, 11, 2, 23), "finance MANAGER"),
            (D(2021, 1, 1), None, TS(2020, 12, 31), "Default"),
            (D(2021, 1, 2), 1, TS(2021, 1, 1), "Default"),
            (D(2021, 3, 1), 2, TS(2021, 2, 28, 1), "Other"),
            (D(2021, 2, 1), 2, TS(2021, 1, 28, 1), "Default")]
    return frame(spark, "user_hist", rows)


def test_snapshots_on_grid(spark):
    grid = report_grid(D(2021, 1, 1), D(2021, 3, 1), 2)
    got = {(r.Report_Date, r.Dealership_id): r for r in activity_snapshots(hist(spark), grid).collect()}
    assert set(got) == {(D(2021, 1, 1), 1), (D(2021, 3, 1), 2)}
    r = got[(D(2021, 1, 1), 1)]
    assert r.Last_Login_anyuser == TS(2020, 12, 30, 9)
    assert (r.Last_Login_Defult, r.Last_Login_Admin, r.Last_Login_FinMgr) == (
        TS(2020, 12, 30, 9), TS(2020, 12, 20, 9), TS(2020, 11, 2, 23))
    assert (r.Day_sin_lastlog_AnyUser, r.Day_sin_lastlog_Admin, r.Day_sin_lastlog_FinMgr) == (2, 12, 60)
    r2 = got[(D(2021, 3, 1), 2)]
    assert r2.Last_Login_Defult is None and r2.Day_sin_lastlog_Defult is None
    assert r2.Day_sin_lastlog_AnyUser == 1


def test_dynamic_partition_overwrite_keeps_other_dates(spark, tmp_path):
    out = str(tmp_path / "snaps")
    snaps = activity_snapshots(hist(spark), [D(2021, 1, 1), D(2021, 3, 1)])
    write_result(snaps, out, partition_by=["Report_Date"])
    only_march = activity_snapshots(hist(spark), [D(2021, 3, 1)])
    write_result(only_march, out, partition_by=["Report_Date"])
    back = spark.read.parquet(out)
    assert sorted(str(r.Report_Date) for r in back.select("Report_Date").distinct().collect()) == [
        "2021-01-01", "2021-03-01"]
    assert back.count() == 2


def test_grid_prunes_date_partitions(spark, tmp_path):
    out = str(tmp_path / "hist")
    hist(spark).write.partitionBy("partition_date").parquet(out)
    stored = spark.read.parquet(out)
    snaps = activity_snapshots(stored, [D(2021, 1, 1), D(2021, 3, 1)])
    plan = snaps._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "partition_date" in plan.split("PartitionFilters: [")[1]
    assert {(r.Report_Date, r.Dealership_id) for r in snaps.collect()} == {(D(2021, 1, 1), 1), (D(2021, 3, 1), 2)}


def test_recommended_conf_scales_with_input():
    from cohortkit.session import recommended_conf
    small, big = recommended_conf(1 << 20, 8), recommended_conf(100 << 40, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
