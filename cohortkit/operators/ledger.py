"""Event ledger: stacking metrics, attributing to reps, pricing, running points, milestones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.sources.contracts import unique_lookup

LEDGER_COLUMNS = ["team", "metric_id", "metric_name", "region", "dealership_id", "date",
                  "metric_volume"]
BI_REPORT = "BI Report: by Dealership_ID"
PERSON_REPORT = "Sales Report: by Person"
# Fixed value: dealer id stamped on hand-reported rows.
MANUAL_DEALER_ID = 999999999
# Running-points milestones and their column names.
MILESTONES = {"date_250K": 250000, "date_500K": 500000, "date_750K": 750000,
              "date_1000K": 1000000}
# Total order used for running totals: the date first, then columns that
# separate every two distinct ledger rows.
TIE_ORDER = ("Report_Type", "team", "metric_id", "region", "dealership_id", "note",
             "metric_volume")


def stamp_metric(rows: DataFrame, team: str, metric_id: int, metric_name: str) -> DataFrame:
    """Ledger rows of one metric: (team, metric id, name, region, dealer, date, volume 1)."""
    return rows.select(
        F.lit(team).alias("team"), F.lit(metric_id).cast("int").alias("metric_id"),
        F.lit(metric_name).alias("metric_name"), F.col("region").cast("string").alias("region"),
        F.col("dealership_id").cast("bigint").alias("dealership_id"),
        F.col("date").cast("date").alias("date"), F.lit(1).cast("bigint").alias("metric_volume"))


def event_ledger(metrics: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of the stamped metric rows (columns by name)."""
    # every input is projected to the same column order, so a positional union is exact
    return reduce(lambda a, b: a.union(b), [m.select(*LEDGER_COLUMNS) for m in metrics])


def _region2(rep: Column, region: Column, overrides: Mapping[str, str]) -> Column:
    out = None
    for name, reg in overrides.items():
        out = F.when(rep == name, F.lit(reg)) if out is None else out.when(rep == name, F.lit(reg))
    return region if out is None else out.otherwise(region)


def attribute_to_rep(ledger: DataFrame, region_rep: DataFrame,
                     overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Rep by (region, team); unmatched rows are kept with a NULL rep."""
    overrides = overrides or {}
    reps = region_rep.select(F.col("region").alias("_r"), F.col("team").alias("_t"), "sales_name")
    out = ledger.join(reps, (ledger.region == reps._r) & (ledger.team == reps._t), "left")
    return out.select(
        F.lit(BI_REPORT).alias("Report_Type"), "sales_name", "team", "metric_id", "metric_name",
        "region", _region2(F.col("sales_name"), F.col("region"), overrides).alias("region2"),
        "dealership_id", "date", "metric_volume", F.lit(None).cast("string").alias("note"))


def assert_unique_reps(region_rep: DataFrame, excluded: Sequence[str] = ()) -> None:
    """Fail when a rep maps to several regions (manual rows would be counted once per region).

    The lookup is a small dimension, so the offending names are brought back.
    """
    named = region_rep.where(F.col("sales_name").isNotNull())  # a vacant territory has no rep
    if excluded:
        named = named.where(~F.col("sales_name").isin(list(excluded)))
    dup = (named.groupBy("sales_name").count().where(F.col("count") > 1).limit(20).collect())
    if dup:
        raise ValueError(f"reps with several regions: {[r.sales_name for r in dup]}")


def manual_event_rows(report: DataFrame, region_rep: DataFrame, excluded: Sequence[str] = (),
                      overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Hand-reported events: region by person (excluded reps keep their rows, lose the region).

    A person of several regions would have each event once per region; the run fails instead.
    """
    overrides = overrides or {}
    reps = region_rep.where(F.col("sales_name").isNotNull())
    if excluded:
        reps = reps.where(~F.col("sales_name").isin(list(excluded)))
    reps = unique_lookup(reps.select("sales_name", F.col("region").alias("_region")), ["sales_name"],
                         "region of a rep").withColumnRenamed("sales_name", "_s")
    out = report.join(reps, report.sales_name == reps._s, "left")
    return out.select(
        F.lit(PERSON_REPORT).alias("Report_Type"), "sales_name", "team", "metric_id",
        "metric_name", F.col("_region").alias("region"),
        _region2(F.col("sales_name"), F.col("_region"), overrides).alias("region2"),
        F.lit(MANUAL_DEALER_ID).cast("bigint").alias("dealership_id"), "date", "metric_volume",
        "note")


def price_events(ledger: DataFrame, bounty: DataFrame) -> DataFrame:
    """Points per unit by (metric, team); ``bounty`` = volume x unit, NULL when unpriced."""
    b = bounty.select(F.col("metric_id").alias("_m"), F.col("team").alias("_t"), "bounty_per_unit")
    out = ledger.join(b, (ledger.metric_id == b._m) & (ledger.team == b._t), "left")
    return out.drop("_m", "_t").withColumn("bounty", F.col("metric_volume") * F.col("bounty_per_unit"))


def attach_dealer_name(ledger: DataFrame, account: DataFrame) -> DataFrame:
    """Dealer name by id; the id is hidden (NULL) on person-reported rows.  A repeated dealer id fails the run."""
    acc = unique_lookup(account.select("dealership_id__c", F.col("name").alias("dealership_name")),
                        ["dealership_id__c"], "account").withColumnRenamed("dealership_id__c", "_id")
    out = ledger.join(acc, ledger.dealership_id == acc._id, "left").drop("_id")
    return out.withColumn("dealership_id", F.when(F.col("Report_Type") == PERSON_REPORT, F.lit(None))
                          .otherwise(F.col("dealership_id")).cast("bigint"))


def volume_flags(ledger: DataFrame) -> DataFrame:
    """Volume with 0 for NULL, and a 0/1 positive-volume flag."""
    v = F.coalesce(F.col("metric_volume"), F.lit(0).cast("bigint"))
    return ledger.withColumn("metric_volume_ind", F.when(v > 0, 1).otherwise(0)) \
                 .withColumn("metric_volume", v)


COPIES = 4096  # equal rows that one task spells out at a time


def running_points(ledger: DataFrame, rep_col: str = "sales_name", points_col: str = "bounty",
                   date_col: str = "date", tie_order: Sequence[str] = TIE_ORDER,
                   ranges: int | None = None, kept: list[DataFrame] | None = None) -> DataFrame:
    """Adds ``cum_sum``: points accumulated per rep in (date, tie order) order.

    NULL points are skipped; the sum is NULL until the first non-NULL points,
    as a SQL running SUM.  Rows equal in every column come one after another.

    Prefix sums by ranges, so no task holds a rep, nor a day of one:

    1. equal rows are combined to one row with their number (partial combine
       before the shuffle, so a hot row is no hot task);
    2. the distinct rows are dealt into ranges of the whole order (rep, date,
       ties); a rep or a day with many rows spreads over several ranges.  The
       dealt rows are persisted, so both steps below read one dealing of them;
       lost blocks are dealt again by the same bounds, as no row depends on its
       place in the input;
    3. each range sums its rows of a rep in order, and what the rep's earlier
       ranges hold (one row per rep and range) is added;
    4. copies are spelled out again, COPIES at a time.

    The persisted rows are appended to ``kept`` (when given) for the caller to release.
    """
    n = ranges or int(ledger.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ledger.columns
    order = [date_col, *tie_order, *[c for c in columns if c not in (rep_col, date_col, *tie_order)]]
    distinct = ledger.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    dealt = (distinct.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in (rep_col, *order)])
             .withColumn("_range", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK))
    if kept is not None:
        kept.append(dealt)
    weight = F.col(points_col) * F.col("_copies")
    earlier = Window.partitionBy(rep_col).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(rep_col, "_range").agg(F.sum(weight).alias("_points"))
               .select(F.col(rep_col).alias("_rep"), F.col("_range").alias("_of"),
                       F.sum("_points").over(earlier).alias("_offset")))
    inside = (Window.partitionBy("_range", rep_col).orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = dealt.withColumn("_inside", F.sum(weight).over(inside))
    rows = rows.join(offsets, (F.col("_range") == F.col("_of")) & F.col(rep_col).eqNullSafe(F.col("_rep")))
    before = F.when(F.col("_offset").isNotNull() | F.col("_inside").isNotNull(),
                    F.coalesce("_offset", F.lit(0)) + F.coalesce("_inside", F.lit(0)))
    rows = rows.select(*columns, "_copies", before.alias("_before"))
    return _spelled_out(rows, n).select(*columns, F.when(F.col(points_col).isNull(), F.col("_before")).otherwise(
        F.coalesce("_before", F.lit(0)) + F.col("_copy") * F.col(points_col)).cast("bigint").alias("cum_sum"))


def _spelled_out(rows: DataFrame, n: int) -> DataFrame:
    """Each row as often as ``_copies`` says, numbered in ``_copy`` from 1; blocks of many copies are dealt anew first."""
    few = rows.where(F.col("_copies") <= COPIES).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    blocks = (rows.where(F.col("_copies") > COPIES)
              .withColumn("_block", F.explode(F.expr(f"sequence(0, (_copies - 1) div {COPIES})")))
              .repartition(n, "_block"))
    many = blocks.withColumn("_copy", F.explode(F.expr(
        f"sequence(_block * {COPIES} + 1, least(_copies, (_block + 1) * {COPIES}))"))).drop("_block")
    return few.unionByName(many)


def milestone_dates(ledger: DataFrame, milestones: Mapping[str, int] = MILESTONES,
                    date_col: str = "date") -> DataFrame:
    """Row-level milestone columns: the row's date once the running total reached each threshold."""
    return ledger.select("*", *[F.when(F.col("cum_sum") >= v, F.col(date_col)).alias(name)
                                for name, v in milestones.items()])


def first_reach(ledger: DataFrame, milestones: Mapping[str, int] = MILESTONES,
                rep_col: str = "sales_name") -> DataFrame:
    """Per rep: the first date each milestone was reached (NULL if never)."""
    return ledger.groupBy(rep_col).agg(*[F.min(name).alias(name) for name in milestones])


def first_n_to_reach(ledger: DataFrame, threshold: int, n: int, rep_col: str = "sales_name",
                     date_col: str = "date") -> DataFrame:
    """The first ``n`` reps to reach ``threshold`` points (ties broken by rep name).

    Reach dates are one row per rep; the top-n is the contest rule itself.
    """
    reach = (ledger.where(F.col("cum_sum") >= threshold).groupBy(rep_col)
             .agg(F.min(date_col).alias("reach_date")))
    # distributed top-n (per-partition top-n, then a merge of n rows per partition)
    return reach.orderBy("reach_date", rep_col).limit(n)


DASHBOARD_COLUMNS = ["Report_Type", "sales_name", "team", "metric_id", "metric_name", "region",
                     "region2", "date", "dealership_id", "dealership_name", "metric_volume",
                     "metric_volume_ind", "bounty_per_unit", "bounty", "note", "cum_sum"]


def contest_rows(attributed: DataFrame, end: dt.date, rep_col: str = "sales_name") -> DataFrame:
    """Rows that enter the running total: a rep is known and the date is not after the end."""
    return attributed.where(F.col(rep_col).isNotNull() & (F.col("date") <= F.lit(end)))
