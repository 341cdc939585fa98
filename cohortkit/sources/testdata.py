"""Source views over the driver's test tables (``/root/testdata/sf*/``).

The eight inputs the programs expect are derived from the TPC-H-like tables:
suppliers play dealers, line items play funded applications, orders play
user-history rows.  Every view reads its whole table; nothing is sampled.
The DuckDB oracle defines the same views from the same rules in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.sources.contracts import conform

# Fixture parameters: the dates the test queries run with.
AS_OF = dt.date(2002, 1, 1)                 # "today": the whole fact is complete
CONTEST_START = dt.date(1998, 2, 1)
CONTEST_END = dt.date(1998, 3, 31)
LOOKBACK_START = dt.date(1997, 1, 1)        # "no event since" floor
ENROL_FLOOR = dt.date(1998, 1, 1)           # enrolment floor of the E5+ metric
LEVEL_DATES = (dt.date(1998, 2, 1), dt.date(1998, 3, 1))
FEATURE_WINDOW_WIDE = (dt.date(1996, 2, 1), dt.date(1996, 12, 31))
FLEX_LAUNCH = dt.date(1998, 1, 1)           # flex applications exist from here on
NEWCOMER_START = dt.date(1998, 2, 10)       # dealers with id % 10 = 3 have no business before
# (priority, metric id, metric name) of hand-reported events
MANUAL_METRICS = (("1-URGENT", 8, "Referral"), ("2-HIGH", 10, "Demo"), ("3-MEDIUM", 11, "Training"),
                  ("4-NOT SPECIFIED", 12, "Visit"), ("5-LOW", 13, "Call"))
GRID_FIRST, GRID_LAST, GRID_STEP = dt.date(1995, 1, 1), dt.date(2001, 8, 1), 1
REP_REGION_OVERRIDES = {"rsm_asia": "South"}
EXCLUDED_REPS = ("bdr_africa",)
# (team, metric_id, points per unit); ("BDR", 8) is deliberately unpriced.
BOUNTY_ROWS = (
    ("RSM", 4, 20000), ("RSM", 5, 30000), ("RSM", 6, 25000), ("RSM", 7, 50000),
    ("RSM", 8, 10000), ("RSM", 10, 500), ("BDR", 11, 300), ("RSM", 13, 100), ("BDR", 2, 25000), ("BDR", 3, 15000), ("BDR", 4, 20000),
    ("BDR", 5, 40000), ("BDR", 6, 30000), ("BDR", 7, 50000), ("BDR", 9, 20000),
)


_TABLES: dict[str, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw test table; the reader (file listing, footer) is made once per session and path."""
    path = f"{str(sf_dir).rstrip('/')}/{name}.parquet"
    cached = _TABLES.get(path)
    if cached is None or cached.sparkSession is not spark:
        cached = _TABLES[path] = spark.read.parquet(path)
    return cached


def _with_region(spark: SparkSession, sf_dir: str, df: DataFrame, key: str, dim_table: str,
                 dim_key: str, nation_key: str) -> DataFrame:
    """Attach ``r_name`` by joining the raw dimension, nation and region scans one by one.

    Joining each raw scan (rather than a pre-joined lookup, whose size Spark
    estimates as a product) lets the planner see three small dimensions.
    """
    dim = table(spark, sf_dir, dim_table).select(F.col(dim_key).alias("_dk"), F.col(nation_key).alias("_nk"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (df.join(dim, F.col(key) == F.col("_dk"), "left")
            .join(nation, F.col("_nk") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .drop("_dk", "_nk", "n_nationkey", "n_regionkey", "r_regionkey"))


def _vehicle_type(linenumber: str) -> F.Column:
    m = F.col(linenumber) % 7
    return (F.when(m == 0, F.lit(None).cast("string")).when(m == 1, "ATV")
            .when(m == 2, "Motorcycle").when(m == 3, "RV").otherwise("Other"))


def _lines_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_region(spark, sf_dir, table(spark, sf_dir, "lineitem"), "l_suppkey",
                        "supplier", "s_suppkey", "s_nationkey")


def _newcomer() -> F.Column:
    return F.col("l_suppkey") % 10 == 3


def _before_newcomer() -> F.Column:
    return _newcomer() & (F.col("l_shipdate").cast("date") < F.lit(NEWCOMER_START))


def fact_funded(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _lines_with_region(spark, sf_dir).select(
        F.col("l_suppkey").alias("dealership_id"),
        F.col("l_shipdate").cast("date").alias("funding_pending_date"),
        F.when((F.col("l_returnflag") == "R") | _before_newcomer(), "No").otherwise("Yes").alias("is_funded"),
        F.lit(1).cast("bigint").alias("count"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_financed"),
        _vehicle_type("l_linenumber").alias("vehicle_type"),
        F.col("r_name").alias("rsm_territory_regions__c"))
    return conform(df, "fact_funded")


def fact_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship = F.col("l_shipdate").cast("date")
    qty = F.col("l_quantity")
    df = _lines_with_region(spark, sf_dir).select(
        F.col("l_suppkey").alias("dealership_id"),
        ship.alias("submitted_at"),
        F.when((qty >= 2) & (qty < 4) & (ship >= F.lit(FLEX_LAUNCH)),
               "direct_to_consumer_flex").otherwise("dealer_portal").alias("source_client"),
        _vehicle_type("l_linenumber").alias("vehicle_type"),
        F.when(((qty < 2) | (_newcomer() & (qty < 25))) & ~_before_newcomer(),
               F.when(F.col("l_linestatus") == "O", "Dealer").otherwise("lightspeed"))
        .otherwise("Consumer").alias("app_type"),
        F.col("r_name").alias("rsm_territory_regions__c"))
    return conform(df, "fact_apps")


def dim_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    reg = (sup.join(nation, sup.s_nationkey == nation.n_nationkey)
           .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    k = F.col("s_suppkey")
    tier = (F.when(k % 7 == 0, "A1 - top").when(k % 7 == 1, "A2").when(k % 7 == 2, "A3 core")
            .when(k % 7 == 3, "B1").when(k % 7 == 4, "B2 - x").when(k % 7 == 5, "B3"))
    enrolled = F.when(k % 5 == 0, F.date_add(F.lit(dt.date(1996, 1, 10)), ((k * 37 + 20) % 1500).cast("int")))
    df = reg.select(
        k.alias("dealership_id__c"),
        F.col("s_name").alias("name"),
        F.lit("Powersports").alias("vertical_type__c"),
        F.lit("Active").alias("status__c"),
        tier.alias("powersports_sales_tier__c"),
        F.col("r_name").alias("rsm_territory_regions__c"),
        enrolled.alias("prequal_integrated_enrolled_date__c"),
        F.when(k % 35 == 0, F.date_add(enrolled, 200)).alias("prequal_integrated_unenrolled_date__c"),
        F.when(k % 3 != 0, F.date_add(F.lit(dt.date(1997, 12, 1)), ((k * 11) % 150).cast("int"))
               .cast("timestamp_ntz")).alias("enrolled_time_stamp__c"),
        F.when(k % 4 == 0, k + 1).alias("previous_dealer_id__c"))
    return conform(df, "dim_account")


def status_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window
    monthly = (table(spark, sf_dir, "lineitem")
               .groupBy(F.col("l_suppkey").alias("dealership_id__c"),
                        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("partition_date"))
               .agg(F.count(F.lit(1)).alias("n")))
    status = (F.when(F.col("n") >= 12, "MVP").when(F.col("n") >= 9, "All-Star")
              .when(F.col("n") >= 6, "Core").otherwise("Base"))
    w = Window.partitionBy("dealership_id__c").orderBy("partition_date")
    df = (monthly.withColumn("full_status", status)
          .withColumn("full_status_prior", F.lag("full_status").over(w)))
    return conform(df, "status_monthly")


def _rep_name(team_prefix: F.Column, region: F.Column) -> F.Column:
    return F.concat(team_prefix, F.lit("_"), F.lower(F.translate(region, " ", "_")))


def region_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    rsm = region.select(F.col("r_name").alias("region"), F.lit("RSM").alias("team"),
                        _rep_name(F.lit("rsm"), F.col("r_name")).alias("sales_name"))
    # one region is left without a BDR rep
    bdr = (region.where(F.col("r_regionkey") != 4)
           .select(F.col("r_name").alias("region"), F.lit("BDR").alias("team"),
                   _rep_name(F.lit("bdr"), F.col("r_name")).alias("sales_name")))
    return conform(rsm.unionByName(bdr), "region_rep")


def manual_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    odate = F.col("o_orderdate").cast("date")
    team = F.when(F.col("o_custkey") % 2 == 0, "RSM").otherwise("BDR")
    metric_id = name = F.lit(None)
    for priority, number, label in MANUAL_METRICS:
        metric_id = F.when(F.col("o_orderpriority") == priority, number).otherwise(metric_id)
        name = F.when(F.col("o_orderpriority") == priority, label).otherwise(name)
    df = (_with_region(spark, sf_dir, orders, "o_custkey", "customer", "c_custkey", "c_nationkey")
          .select(_rep_name(F.lower(team), F.col("r_name")).alias("sales_name"),
                  team.alias("team"),
                  metric_id.cast("int").alias("metric_id"),
                  name.alias("metric_name"),
                  odate.alias("date"),
                  F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.lit(1))
                  .cast("bigint").alias("metric_volume"),
                  F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("note")))
    return conform(df, "manual_report")


def bounty(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Points per unit: a small fixed lookup (metric registry), broadcast on use."""
    df = spark.createDataFrame(
        [(m, t, p) for t, m, p in BOUNTY_ROWS],
        "metric_id int, team string, bounty_per_unit bigint")
    return conform(df, "bounty")


def user_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    part = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    key = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    login = (part.cast("timestamp_ntz")
             - F.make_dt_interval(((key * 13) % 90).cast("int"))
             + F.make_dt_interval(F.lit(0), (key % 24).cast("int")))
    df = orders.select(
        part.alias("partition_date"),
        F.when(key % 50 == 0, F.lit(None)).otherwise(F.col("o_custkey")).cast("bigint")
        .alias("dealership_id"),
        login.alias("last_login"),
        F.when(prio == "1-URGENT", "Default").when(prio == "2-HIGH", "ADMINISTRATOR")
        .when(prio == "3-MEDIUM", "Finance Manager").otherwise("Sales Rep")
        .alias("dealer_user_type"))
    return conform(df, "user_hist")


SOURCES = {
    "fact_funded": fact_funded, "fact_apps": fact_apps, "dim_account": dim_account,
    "status_monthly": status_monthly, "region_rep": region_rep,
    "manual_report": manual_report, "bounty": bounty, "user_hist": user_hist,
}
