"""Dense monthly panel of treated dealers against their synthetic peer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.dates import month_diff
from cohortkit.functions.predicates import tier_label
from cohortkit.operators.cohorts import last_complete_day
from cohortkit.operators.matching import PEER_CELL, TREATED_CELL


def peer_monthly(selected: DataFrame, monthly: DataFrame) -> DataFrame:
    """Monthly measures of each selected peer from its dealer's M0 on, a row per dealer, peer and month.

    Equi-join on the peer id against the dealer-month aggregate, month >= M0
    as residual.  Its size is its output's; the lift sums by ``cell_months``.
    """
    m = monthly.select(F.col("dealership_id").alias("_peer"), "Funding_MM",
                       F.col("Funded").alias("Funded_Apps"), F.col("Orig").alias("Orig_Amt"))
    return (selected.select("M0", "dealership_id__c", "Peer_Dealership_id")
            .join(m, (F.col("Peer_Dealership_id") == m._peer) & (m.Funding_MM >= F.col("M0")))
            .select("M0", "dealership_id__c", "Peer_Dealership_id", "Funding_MM",
                    "Funded_Apps", "Orig_Amt"))


def cell_months(members: DataFrame, picked: DataFrame, monthly: DataFrame) -> DataFrame:
    """Monthly measures of all peers of each treated cell, from its M0 on: raw sums ``Funded``, ``Orig``.

    Two sums, each with a partial combine: the months of each picked peer cell's members, once
    per cohort month, then of each treated cell over its peer cells.  So a peer's months are read
    once for a cohort however many dealers chose it, and nothing has the size dealers x peers x
    months.
    """
    m = monthly.select(F.col("dealership_id").alias("_peer"), "Funding_MM",
                       F.col("Funded").alias("_funded"), F.col("Orig").alias("_orig"))
    of_cells = (members.join(m, (members.Peer_Dealership_id == m._peer) & (m.Funding_MM >= members.M0))
                .groupBy("M0", *PEER_CELL, "Funding_MM")
                .agg(F.sum("_funded").alias("_funded"), F.sum("_orig").alias("_orig")))
    return (picked.select(*TREATED_CELL, *PEER_CELL).join(of_cells, ["M0", *PEER_CELL])
            .groupBy(*TREATED_CELL, "Funding_MM")
            .agg(F.sum("_funded").alias("Funded"), F.sum("_orig").cast("decimal(38,2)").alias("Orig")))


def synthetic_peer(months: DataFrame, profile: DataFrame, normaliser: DataFrame) -> DataFrame:
    """One synthetic peer per dealer and month: its cell's peer sums divided by the dealer's ratios.

    Raw sums are kept (``Funded``, ``Orig``) so cumulative figures can be
    taken exactly before the division.
    """
    keys = ["M0", "dealership_id__c"]
    ratios = normaliser.select(*keys, "Norm_Ratio_Fund", "Norm_Ratio_Orig")
    dealers = profile.select(*TREATED_CELL, "dealership_id__c").join(ratios, keys)
    out = dealers.join(months, TREATED_CELL)
    return out.select(
        *keys, "Funding_MM", "Norm_Ratio_Fund", "Norm_Ratio_Orig", "Funded", "Orig",
        F.try_divide(F.col("Funded").cast("double"), F.col("Norm_Ratio_Fund")).alias("Norm_Funded"),
        F.try_divide(F.col("Orig").cast("double"), F.col("Norm_Ratio_Orig")).alias("Norm_Orig"))


def dense_panel(normaliser: DataFrame, spine: DataFrame, as_of: dt.date) -> DataFrame:
    """Each treated dealer x each calendar month of the spine from its M0 on.

    Months are generated per dealer with ``sequence`` (at most the calendar
    span) and equi-joined with the broadcast spine, so months without any
    fact row are skipped exactly as with the spine itself.  No cross join.
    """
    last_month = F.lit(last_complete_day(as_of).replace(day=1))
    dealers = normaliser.select("M0", "dealership_id__c", "w_Peer_Ind", "Peer_Cnt")
    months = dealers.where(F.col("M0") <= last_month).withColumn(
        "Calendar_MM", F.explode(F.sequence(F.col("M0"), last_month, F.expr("INTERVAL 1 MONTH"))))
    return months.join(F.broadcast(spine), "Calendar_MM").select(
        "M0", "dealership_id__c", "w_Peer_Ind", "Peer_Cnt", "Calendar_MM")


def fill_panel(panel: DataFrame, monthly: DataFrame) -> DataFrame:
    """Attach the dealer's own monthly measures, 0 where it had none."""
    m = monthly.select(F.col("dealership_id").alias("_d"), F.col("Funding_MM").alias("_m"),
                       "Funded", "Orig")
    out = panel.join(m, (panel.dealership_id__c == m._d) & (panel.Calendar_MM == m._m), "left")
    return out.select(
        "M0", "dealership_id__c", "w_Peer_Ind", "Peer_Cnt", "Calendar_MM",
        F.coalesce("Funded", F.lit(0).cast("bigint")).alias("Funded_app"),
        F.coalesce("Orig", F.lit(0).cast("decimal(28,2)")).alias("Orig_amt"))


def cohort_sizes(normaliser: DataFrame) -> DataFrame:
    """Per cohort month: treated dealers and treated dealers with a peer."""
    return normaliser.groupBy("M0").agg(
        F.count_distinct("dealership_id__c").alias("M0_PrequalD_Cnt"),
        F.sum(F.when(F.col("w_Peer_Ind") == 1, 1).otherwise(0)).cast("bigint")
        .alias("M0_PrequalD_wPeer_Cnt"))


def lift_panel(filled: DataFrame, synthetic: DataFrame, sizes: DataFrame) -> DataFrame:
    """Panel + synthetic peer + cohort sizes + months since M0 (``MM``)."""
    syn = synthetic.select(
        F.col("M0").alias("_m0"), F.col("dealership_id__c").alias("_d"),
        F.col("Funding_MM").alias("_mm"), "Norm_Funded", "Norm_Orig",
        F.col("Funded").alias("Peer_Funded_Raw"), F.col("Orig").alias("Peer_Orig_Raw"),
        "Norm_Ratio_Fund", "Norm_Ratio_Orig")
    out = filled.join(syn, (filled.M0 == syn._m0) & (filled.dealership_id__c == syn._d)
                      & (filled.Calendar_MM == syn._mm), "left")
    out = out.join(F.broadcast(sizes), "M0", "left")
    return out.select(
        "M0", "M0_PrequalD_Cnt", "M0_PrequalD_wPeer_Cnt", "dealership_id__c", "w_Peer_Ind",
        "Peer_Cnt", "Calendar_MM", month_diff("M0", "Calendar_MM").alias("MM"),
        "Funded_app", "Orig_amt", "Norm_Funded", "Norm_Orig",
        "Peer_Funded_Raw", "Peer_Orig_Raw", "Norm_Ratio_Fund", "Norm_Ratio_Orig")


def cohort_tenure(cohort_m0: DataFrame, spine: DataFrame, as_of: dt.date) -> DataFrame:
    """Per cohort month: ``M0_Tenure``, the largest ``MM`` of its panel rows.

    Every dealer of a cohort is paired with the same spine months, so the
    cohort's largest MM is the distance from M0 to the last spine month at
    or after it.  Computed on the cohort months alone (months generated
    per cohort, equi-joined with the broadcast spine), not on the panel and
    not with a window over a cohort.
    """
    last_month = F.lit(last_complete_day(as_of).replace(day=1))
    m0 = cohort_m0.select("M0").distinct().where(F.col("M0") <= last_month)
    months = m0.withColumn("Calendar_MM", F.explode(
        F.sequence(F.col("M0"), last_month, F.expr("INTERVAL 1 MONTH"))))
    return (months.join(F.broadcast(spine), "Calendar_MM")
            .groupBy("M0").agg(F.max(month_diff("M0", "Calendar_MM")).alias("M0_Tenure")))


def with_tenure(panel: DataFrame, tenure: DataFrame) -> DataFrame:
    """Attach ``M0_Tenure`` on every panel row (broadcast: one row per cohort month)."""
    return panel.join(F.broadcast(tenure), "M0", "left")


REPORT_COLUMNS = ["M0", "M0_Tenure", "M0_PrequalD_Cnt", "M0_PrequalD_wPeer_Cnt", "Dealership_ID",
                  "Dealership_Name", "w_Peer_Ind", "Peer_Cnt", "Dealership_Tier", "Calendar_MM",
                  "MM", "Funding", "Orig", "Funding_Peer", "Orig_Peer"]


def attach_account(panel: DataFrame, account: DataFrame) -> DataFrame:
    """Dealer name and tier label from the account dimension (the 15 report columns)."""
    acc = account.select(F.col("dealership_id__c").alias("_id"), F.col("name").alias("Dealership_Name"),
                         tier_label("powersports_sales_tier__c").alias("Dealership_Tier"))
    out = panel.join(acc, panel.dealership_id__c == acc._id, "left")
    return out.select(
        "M0", "M0_Tenure", "M0_PrequalD_Cnt", "M0_PrequalD_wPeer_Cnt",
        F.col("dealership_id__c").alias("Dealership_ID"), "Dealership_Name", "w_Peer_Ind",
        "Peer_Cnt", "Dealership_Tier", "Calendar_MM", "MM",
        F.col("Funded_app").alias("Funding"), F.col("Orig_amt").cast("double").alias("Orig"),
        F.col("Norm_Funded").alias("Funding_Peer"), F.col("Norm_Orig").alias("Orig_Peer"))


def lift(panel: DataFrame) -> DataFrame:
    """% lift of each dealer over its synthetic peer, monthly and cumulative since M0.

    Monthly: own / peer - 1.  Cumulative: running own total over the running
    raw peer total divided by the same ratio (exact running sums, one
    division).  The window is one dealer's months: bounded by the calendar.
    """
    dealer = Window.partitionBy("M0", "dealership_id__c")
    w = dealer.orderBy("Calendar_MM").rowsBetween(Window.unboundedPreceding, 0)
    # the ratios are per dealer; months without peer activity carry NULL, so take the partition max
    ratio_f = F.max("Norm_Ratio_Fund").over(dealer)
    ratio_o = F.max("Norm_Ratio_Orig").over(dealer)
    cum_own_f = F.sum("Funded_app").over(w)
    cum_own_o = F.sum("Orig_amt").over(w)
    cum_peer_f = F.try_divide(F.sum("Peer_Funded_Raw").over(w).cast("double"), ratio_f)
    cum_peer_o = F.try_divide(F.sum("Peer_Orig_Raw").over(w).cast("double"), ratio_o)
    return panel.select(
        "M0", F.col("dealership_id__c").alias("Dealership_ID"), "Calendar_MM", "MM",
        (F.try_divide(F.col("Funded_app").cast("double"), F.col("Norm_Funded")) - 1).alias("Funding_Lift"),
        (F.try_divide(F.col("Orig_amt").cast("double"), F.col("Norm_Orig")) - 1).alias("Orig_Lift"),
        (F.try_divide(cum_own_f.cast("double"), cum_peer_f) - 1).alias("Cum_Funding_Lift"),
        (F.try_divide(cum_own_o.cast("double"), cum_peer_o) - 1).alias("Cum_Orig_Lift"))
