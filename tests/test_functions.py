import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortkit.functions import (add_months_py, growth_band, level_up, month_diff, report_grid,
                                 size_band, tier_label, vehicle_class_filter)

D = dt.date


def test_grid_of_documented_call():
    grid = report_grid("2021-01-01", "2022-09-01", 2)
    assert len(grid) == 11
    assert grid[0] == D(2021, 1, 1) and grid[-1] == D(2022, 9, 1)
    assert grid[1] == D(2021, 3, 1)


def test_grid_overshoots_and_always_steps_once():
    assert report_grid(D(2021, 1, 1), D(2021, 4, 1), 2) == [D(2021, 1, 1), D(2021, 3, 1), D(2021, 5, 1)]
    assert report_grid(D(2021, 5, 1), D(2021, 5, 1), 1) == [D(2021, 5, 1), D(2021, 6, 1)]


def test_grid_drifts_at_month_end():
    assert report_grid(D(2021, 1, 31), D(2021, 3, 31), 1) == [
        D(2021, 1, 31), D(2021, 2, 28), D(2021, 3, 28), D(2021, 4, 28)]


def test_grid_rejects_non_positive_step():
    with pytest.raises(ValueError):
        report_grid(D(2021, 1, 1), D(2021, 3, 1), 0)


def test_python_month_add_matches_spark(spark):
    days = [D(2020, 1, 31), D(2020, 2, 29), D(2021, 12, 31), D(2019, 3, 30), D(2024, 5, 15)]
    steps = [-13, -1, 1, 2, 11, 25]
    df = spark.createDataFrame([(d, s) for d in days for s in steps], "d date, s int")
    got = {(r.d, r.s): r.m for r in df.select("d", "s", F.add_months("d", F.col("s")).alias("m")).collect()}
    assert all(add_months_py(d, s) == got[(d, s)] for d in days for s in steps)


def test_month_diff_on_month_starts(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), D(2021, 3, 1)), (D(2021, 3, 1), D(2020, 1, 1))], "a date, b date")
    assert [r.m for r in df.select(month_diff("a", "b").alias("m")).collect()] == [14, -14]


def test_growth_bands_are_nested(spark):
    import random
    rnd = random.Random(7)
    values = [0.0, None] + [rnd.uniform(-3, 3) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "g double")
    cols = []
    for name, t in {"h": 0.05, "f": 0.10, "w": 0.50}.items():
        lo, hi = growth_band("g", t)
        cols += [lo.alias(f"lo_{name}"), hi.alias(f"hi_{name}")]
    for r in df.select("g", *cols).collect():
        if r.g is None:
            assert r.lo_w is None and r.hi_w is None
            continue
        assert r.lo_w <= r.lo_f <= r.lo_h <= r.hi_h <= r.hi_f <= r.hi_w
        if r.g != 0:
            assert r.lo_h <= r.g <= r.hi_h


def test_size_band_null_when_not_positive(spark):
    df = spark.createDataFrame([(0,), (-3,), (8,)], "x bigint")
    lo, hi = size_band("x", 0.25)
    rows = df.select("x", lo.alias("lo"), hi.alias("hi")).orderBy("x").collect()
    assert [(r.lo, r.hi) for r in rows] == [(None, None), (None, None), (6.0, 10.0)]


def test_tier_label_first_match_else_raw(spark):
    df = spark.createDataFrame([("A1 - top",), ("x B2 A3",), ("Z9",), (None,)], "t string")
    got = [r.l for r in df.select(tier_label("t").alias("l")).collect()]
    assert got == ["A1", "A3", "Z9", None]


def test_vehicle_filter_treats_null_as_excluded(spark):
    df = spark.createDataFrame([("ATV",), ("RV",), (None,), ("Mower",), ("Other",)], "v string")
    assert sorted(r.v for r in df.where(vehicle_class_filter("v")).collect()) == ["ATV", "Other"]


def test_level_up_three_valued(spark):
    rows = [("MVP", "All-Star"), ("All-Star", "Core"), ("All-Star", "MVP"), ("MVP", None),
            ("Core", "Base"), ("MVP", "MVP")]
    df = spark.createDataFrame(rows, "s string, p string")
    got = [r.f for r in df.select(level_up("s", "p").alias("f")).collect()]
    assert got == [1, 1, 0, 0, 0, 0]


def test_grid_matches_recursive_sql_grid():
    """Property: the driver-side grid equals a do-while grid built by DuckDB's own month add."""
    import duckdb
    from hypothesis import given, settings
    from hypothesis import strategies as st

    con = duckdb.connect()

    @settings(max_examples=60, deadline=None)
    @given(first=st.dates(min_value=D(1990, 1, 1), max_value=D(2030, 12, 31)),
           span_days=st.integers(min_value=0, max_value=2000),
           step=st.integers(min_value=1, max_value=14))
    def check(first, span_days, step):
        last = first + dt.timedelta(days=span_days)
        sql = f"""
            WITH RECURSIVE g(d, n) AS (
                SELECT DATE '{first}', 0
                UNION ALL
                SELECT CAST(d + INTERVAL ({step}) MONTH AS DATE), n + 1 FROM g
                WHERE n = 0 OR d < DATE '{last}')
            SELECT d FROM g ORDER BY n"""
        assert report_grid(first, last, step) == [r[0] for r in con.execute(sql).fetchall()]

    check()
