"""Results replaced as a whole, first dates kept as a state, lookups checked in the plan, bucketed joins."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import cohorts as C
from cohortkit.operators import ledger as L
from cohortkit.operators.events import first_event_in_window
from cohortkit.operators.first_dates import FirstDates, first_dates, first_in_window, merge_first_dates
from cohortkit.operators.matching import picked_members
from cohortkit.operators.sink import write_result
from cohortkit.plans.lift_report import lift_stages
from cohortkit.sources.contracts import unique_lookup
from tests.fixtures import D, account_row, frame, random_peer_world

AS_OF = D(2022, 1, 15)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def database(spark, tmp_path):
    name = "sinks_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def broken(spark):
    """Rows of which the last fails while it is written."""
    return spark.range(0, 1000, 1, 4).select(F.when(F.col("id") < 999, F.col("id")).otherwise(
        F.raise_error(F.lit("no such row"))).cast("long").alias("id"))


# ------------------------------------------------------------------ replace

def test_a_path_is_replaced_from_itself(spark, tmp_path):
    out = str(tmp_path / "result")
    write_result(spark.range(10), out)
    write_result(spark.read.parquet(out).where("id < 4"), out)
    assert rows(spark.read.parquet(out)) == [(0,), (1,), (2,), (3,)]
    assert os.listdir(tmp_path) == ["result"]


def test_a_failed_write_leaves_the_path_as_it_was(spark, tmp_path):
    out = str(tmp_path / "result")
    write_result(spark.range(3), out)
    with pytest.raises(Exception, match="no such row"):
        write_result(broken(spark), out)
    assert rows(spark.read.parquet(out)) == [(0,), (1,), (2,)] and os.listdir(tmp_path) == ["result"]


def test_a_failed_first_write_leaves_nothing(spark, tmp_path):
    with pytest.raises(Exception, match="no such row"):
        write_result(broken(spark), str(tmp_path / "result"))
    assert os.listdir(tmp_path) == []


def test_a_table_is_replaced_from_itself_and_kept_on_failure(spark, database):
    table = f"{database}.result"
    write_result(spark.range(10), table=table)
    write_result(spark.table(table).where("id < 3").selectExpr("id", "id * 2 as twice"), table=table)
    assert rows(spark.table(table)) == [(0, 0), (1, 2), (2, 4)]
    with pytest.raises(Exception, match="no such row"):
        write_result(broken(spark), table=table)
    assert rows(spark.table(table)) == [(0, 0), (1, 2), (2, 4)]
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["result"]


def test_append_matches_columns_by_name(spark, database):
    table = f"{database}.result"
    write_result(spark.sql("select 1 a, 'x' b"), table=table, mode="append")
    write_result(spark.sql("select 'y' b, 2 a"), table=table, mode="append")
    assert rows(spark.table(table)) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="columns"):
        write_result(spark.sql("select 1 a"), table=table, mode="append")
    with pytest.raises(ValueError, match="mode"):
        write_result(spark.range(1), table=table, mode="replace")


# ------------------------------------------------------------------ first dates

def events(spark, tmp_path, seed=4):
    rng = random.Random(seed)
    days = [D(2023, 1, 1) + dt.timedelta(days=i) for i in range(0, 450, 9)]
    found = [(rng.choice(["W", "E", None]), rng.choice([*range(300), None]), rng.choice(days), rng.choice("ab")) for _ in range(2500)]
    df = spark.createDataFrame(found, "region string, dealership_id long, day date, kind string")
    df.repartition(2).write.mode("overwrite").partitionBy("day").parquet(str(tmp_path / "events"))
    return spark.read.parquet(str(tmp_path / "events"))


@pytest.mark.parametrize("since", [None, D(2023, 3, 1)])
def test_updates_in_steps_equal_one_run(spark, tmp_path, since):
    df, where, end = events(spark, tmp_path), F.col("kind") == "a", D(2024, 3, 31)
    state = FirstDates(spark, str(tmp_path / f"state{since}"), since=since)
    assert state.through() is None
    for upto in (D(2023, 6, 1), D(2023, 6, 1), D(2024, 1, 31), D(2023, 12, 1), end):
        state.update(df, upto, "day", where)
    assert state.through() == end
    for start in (D(2023, 5, 1), D(2024, 1, 1), D(2024, 2, 10)):
        want = first_event_in_window(df, start, end, "day", lookback_start=since, where=where)
        got = first_in_window(state.read(), start, end)
        assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(first_in_window(state.read(), D(2023, 4, 1), D(2023, 5, 1))) == rows(
        first_event_in_window(df, D(2023, 4, 1), D(2023, 5, 1), "day", lookback_start=since, where=where))


def test_an_update_reads_new_partitions_only(spark, tmp_path):
    df = events(spark, tmp_path)
    state = FirstDates(spark, str(tmp_path / "state"))
    state.update(df, D(2024, 1, 31), "day")
    fewer = df.where("day > date'2024-01-31'")  # the past is gone, the state holds it
    state.update(fewer, D(2024, 3, 31), "day")
    assert rows(state.read()) == rows(first_dates(df, "day"))
    plan = first_dates(df.where((F.col("day") <= F.lit(D(2024, 3, 31))) & (F.col("day") > F.lit(D(2024, 1, 31)))), "day")
    assert "day" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_a_failed_update_leaves_the_state(spark, tmp_path):
    df = events(spark, tmp_path)
    state = FirstDates(spark, str(tmp_path / "state"))
    state.update(df, D(2023, 6, 1), "day")
    before = rows(state.read())
    with pytest.raises(Exception, match="no such row"):
        state.update(df, D(2024, 1, 1), "day", F.when(F.col("kind") == "a", F.raise_error(F.lit("no such row")).cast("boolean")).otherwise(True))
    assert rows(state.read()) == before and state.through() == D(2023, 6, 1)


def test_states_merge_in_any_order_and_empty_ones_too(spark, tmp_path):
    df = events(spark, tmp_path)
    parts = [first_dates(df.where(F.pmod(F.hash("day"), F.lit(3)) == i), "day") for i in range(3)]
    want = rows(first_dates(df, "day"))
    assert rows(merge_first_dates(merge_first_dates(parts[2], parts[0]), parts[1])) == want
    assert rows(merge_first_dates(parts[0].where("false"), first_dates(df, "day"))) == want
    state = FirstDates(spark, str(tmp_path / "state"))
    state.update(df.where("false"), D(2023, 1, 1), "day")
    assert state.through() == D(2023, 1, 1) and state.read().count() == 0


# ------------------------------------------------------------------ lookups

def test_a_repeated_key_fails_the_run_that_uses_it(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (None, "d")], "k long, v string")
    with pytest.raises(Exception, match="places is not unique on k: 2"):
        unique_lookup(df, ["k"], "places").collect()
    assert rows(unique_lookup(df.where("k = 1 or k is null"), ["k"])) == [(1, "a")]


def test_a_rep_of_two_regions_fails_the_manual_rows(spark):
    report = frame(spark, "manual_report", [("ann", "RSM", 8, "Referral", D(2024, 1, 5), 1, "x")])
    reps = [("W", "RSM", "ann"), ("E", "BDR", "ann"), (None, None, None), (None, None, None)]
    with pytest.raises(Exception, match="region of a rep is not unique on sales_name: ann"):
        L.manual_event_rows(report, frame(spark, "region_rep", reps)).collect()
    kept = L.manual_event_rows(report, frame(spark, "region_rep", reps), excluded=["ann"]).collect()
    assert [(r.sales_name, r.region) for r in kept] == [("ann", None)]


def test_a_repeated_dealer_fails_the_names(spark):
    ledger = spark.createDataFrame([(1, "x")], "dealership_id long, Report_Type string")
    twice = frame(spark, "dim_account", [account_row(1), account_row(1)])
    with pytest.raises(Exception, match="account is not unique on dealership_id__c: 1"):
        L.attach_dealer_name(ledger, twice).collect()
    assert L.attach_dealer_name(ledger, twice.limit(1)).first().dealership_name == "dealer 1"


# ------------------------------------------------------------------ buckets

def test_the_stored_aggregate_is_not_shuffled_again(spark, database):
    facts, accounts, _ = random_peer_world()
    fact, account = frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts)
    plain = lift_stages(fact, account, AS_OF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        st = lift_stages(fact, account, AS_OF, activity_table=f"{database}.activity", buckets=4)
        assert rows(st.report) == rows(plain.report)
        for joined in (C.never_enrolled(st.monthly, account), st.filled):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan
            of_table = plan[:plan.index("Bucketed: true")].splitlines()
            depth = of_table[-1].index("FileScan")
            above = [line for line in of_table if "Exchange" in line and "Join" not in line]
            # an exchange over the scan would stand one or more levels above it in the same branch
            branch = []
            for line in reversed(of_table):
                at = len(line) - len(line.lstrip(" :+-*()0123456789"))
                if at < depth:
                    branch.append(line)
                    depth = at
            assert not [b for b in branch[:next(i for i, b in enumerate(branch) if "Join" in b)] if "Exchange" in b], above
        st.release()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        plain.release()


def test_counted_cells_add_up_to_all_pairs(spark):
    from cohortkit.operators.matching import match_cell_counts

    facts, accounts, treated = random_peer_world()
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts), AS_OF, all_time=True)
    found = match_cell_counts(st.profile, st.candidates, st.pool).collect()
    assert sum(r.n_dealers * r.n_peers for r in found) == len(treated) * st.pool.count()
    assert sum(r.n_dealers * r.n_peers for r in found if r.selectable) == st.pairs.count()
    none = match_cell_counts(st.profile, st.candidates.where("false"), st.pool.where("false")).collect()
    assert sum(r.n_dealers for r in none) == len(treated) and {(r.selectable, r.n_peers) for r in none} == {(0, 0)}
    assert picked_members(st.candidates, st.picked).count() > 0
    st.release()
