"""Batch jobs: read the inputs, build a program, write its result table.

Inputs are catalog table names or parquet paths; each is conformed to its
contract (checked, cast, pruned).  Results are written with ``write_result``:
the lift report and the dashboard replace their table, the snapshots replace
only the report dates they contain.

    python -m cohortkit.plans.jobs lift --fact sales.funded --account crm.accounts \
        --as-of 2024-04-15 --out analytics.peer_lift
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession

from cohortkit.operators.sink import write_result
from cohortkit.operators.snapshots import activity_snapshots_on_grid
from cohortkit.plans.contest import ContestParams, Sources, contest_dashboard
from cohortkit.plans.lift_report import lift_stages
from cohortkit.sources.contracts import conform


def read_source(spark: SparkSession, ref: str, contract: str) -> DataFrame:
    """A catalog table (``db.table``) or a parquet path, conformed to ``contract``."""
    df = spark.read.parquet(ref) if "/" in ref else spark.table(ref)
    return conform(df, contract)


def _write(df: DataFrame, out: str, partition_by: Sequence[str] | None = None) -> None:
    if "/" in out:
        write_result(df, out, partition_by=partition_by)
    else:
        write_result(df, table=out, partition_by=partition_by)


def lift_report_job(spark: SparkSession, fact: str, account: str, as_of: dt.date, out: str,
                    low: int = 4, high: int = 10, validate: bool = True) -> None:
    stages = lift_stages(read_source(spark, fact, "fact_funded"),
                         read_source(spark, account, "dim_account"), as_of, low=low, high=high)
    if validate:
        stages.validate()
    _write(stages.report, out)
    stages.release()


def contest_job(spark: SparkSession, inputs: Mapping[str, str], params: ContestParams, out: str,
                validate: bool = True) -> None:
    """``inputs`` names: fact_funded, fact_apps, dim_account, status_monthly, region_rep,
    manual_report, bounty."""
    s = Sources(*(read_source(spark, inputs[n], n) for n in
                  ("fact_funded", "fact_apps", "dim_account", "status_monthly", "region_rep",
                   "manual_report", "bounty")))
    kept: list[DataFrame] = []
    dash = contest_dashboard(s, params, validate=validate, kept=kept)
    _write(dash, out)
    for df in kept:
        df.unpersist()


def snapshots_job(spark: SparkSession, hist: str, first: dt.date, last: dt.date, step: int,
                  out: str) -> None:
    snaps = activity_snapshots_on_grid(read_source(spark, hist, "user_hist"), first, last, step)
    _write(snaps, out, partition_by=["Report_Date"])


def main(argv: Sequence[str] | None = None) -> None:
    day = dt.date.fromisoformat
    p = argparse.ArgumentParser(prog="cohortkit.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    lift = sub.add_parser("lift")
    lift.add_argument("--fact", required=True)
    lift.add_argument("--account", required=True)
    lift.add_argument("--as-of", type=day, default=dt.date.today())
    lift.add_argument("--low", type=int, default=4)
    lift.add_argument("--high", type=int, default=10)
    lift.add_argument("--out", required=True)
    snap = sub.add_parser("snapshots")
    snap.add_argument("--hist", required=True)
    snap.add_argument("--first", type=day, required=True)
    snap.add_argument("--last", type=day, required=True)
    snap.add_argument("--step", type=int, required=True)
    snap.add_argument("--out", required=True)
    con = sub.add_parser("contest")
    for name in ("fact_funded", "fact_apps", "dim_account", "status_monthly", "region_rep",
                 "manual_report", "bounty"):
        con.add_argument(f"--{name.replace('_', '-')}", required=True)
    con.add_argument("--start", type=day, required=True)
    con.add_argument("--end", type=day, required=True)
    con.add_argument("--lookback-start", type=day, required=True)
    con.add_argument("--enrol-floor", type=day, required=True)
    con.add_argument("--level-dates", type=lambda v: [day(x) for x in v.split(",")], required=True)
    con.add_argument("--exclude-reps", default="")
    con.add_argument("--region-overrides", default="", help="rep=region, comma separated")
    con.add_argument("--feature-window", type=lambda v: tuple(day(x) for x in v.split(",")))
    con.add_argument("--milestones", default="", help="column=points, comma separated")
    defaults = {f.name: f.default for f in fields(ContestParams)}
    for name in ("yoy_n", "history_n", "nth_n", "flex_client", "vertical"):
        con.add_argument(f"--{name.replace('_', '-')}", type=type(defaults[name]), default=defaults[name])
    for name in ("app_types", "top_levels", "excluded_classes"):
        con.add_argument(f"--{name.replace('_', '-')}", type=lambda v: tuple(v.split(",")), default=defaults[name])
    con.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.job == "lift":
        lift_report_job(spark, a.fact, a.account, a.as_of, a.out, a.low, a.high)
    elif a.job == "snapshots":
        snapshots_job(spark, a.hist, a.first, a.last, a.step, a.out)
    else:
        inputs = {n: getattr(a, n) for n in ("fact_funded", "fact_apps", "dim_account",
                                             "status_monthly", "region_rep", "manual_report", "bounty")}
        pairs = lambda text: dict(x.split("=", 1) for x in text.split(",") if x)
        same = ("yoy_n", "history_n", "nth_n", "flex_client", "vertical", "app_types", "top_levels",
                "excluded_classes", "feature_window")
        params = ContestParams(a.start, a.end, a.lookback_start, a.enrol_floor, a.level_dates,
                               excluded_reps=[r for r in a.exclude_reps.split(",") if r],
                               rep_region_overrides=pairs(a.region_overrides),
                               **{n: getattr(a, n) for n in same})
        if a.milestones:
            params = replace(params, milestones={k: int(v) for k, v in pairs(a.milestones).items()})
        contest_job(spark, inputs, params, a.out)


if __name__ == "__main__":
    main()
