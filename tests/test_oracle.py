"""Registered queries against their DuckDB oracles on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from cohortkit.plans.contest import METRICS
from cohortkit.plans.registry import REGISTRY
from tests.conftest import SMOKE
from tools_compare import TABLES, frame_rows

KEYS = ["a21_peer_lift_report", "a21_peer_lift_report_low_thresholds", "a22_lift",
        "a40_contest_dashboard", "a40_contest_dashboard_wide_feature", "a43_activity_snapshots",
        "a24_yoy_new_threshold", "a45_first_n_to_reach", "a10_match_flags",
        "a11_adaptive_peers_low_thresholds", "a33_attribute_to_rep", "a38_running_points"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_query_compares_empty_with_empty(name):
    """Rows of each oracle at sf0.01, the scale of the correctness gate."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    assert con.execute(f"SELECT count(*) FROM ({E.oracle_sql()[name]})").fetchone()[0] > 0


def test_every_contest_metric_has_events():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    found = con.execute(f"SELECT DISTINCT team, metric_id FROM ({E.oracle_sql()['a32_event_ledger']})").fetchall()
    assert set(found) == {(m.team, m.metric_id) for m in METRICS}


def test_the_oracle_does_not_use_the_library():
    folder = Path(__file__).parent.parent / "sql_oracle"
    assert not [p.name for p in folder.glob("*.py") if "cohortkit" in p.read_text()]


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SMOKE).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert frame_rows(got) == frame_rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) == 15
