"""Cohorts of feature adopters, their baseline months and the candidate pool.

Scale notes: the fact is aggregated once to dealer x month (partial/final hash
aggregate, so a hot dealer is combined map-side) and every later step joins
that aggregate, never the raw fact.  The only broadcasts are lists of months,
bounded by the span of the calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.bands import growth_band, size_band
from cohortkit.functions.dates import month_start, to_date_col

# Growth tolerances by band name (first pass, wide, narrow).
GROWTH_TOLERANCES = {"1": 0.10, "2L": 0.50, "2H": 0.05}
SIZE_TOLERANCE = 0.25


def last_complete_day(as_of: dt.date) -> dt.date:
    """Day before the first of the ``as_of`` month (end of the last complete month)."""
    return as_of.replace(day=1) - dt.timedelta(days=1)


def funded_predicate(col: str = "is_funded", case_sensitive: bool = False) -> Column:
    """``is_funded`` equals yes; case-folded unless ``case_sensitive``."""
    return F.col(col) == "Yes" if case_sensitive else F.lower(F.col(col)) == "yes"


def dealer_month_activity(fact: DataFrame, case_sensitive: bool = False,
                          date_col: str = "funding_pending_date") -> DataFrame:
    """One pass over the fact: per dealer and month, all rows and the funded measures.

    Both the month spine (months with any row) and the funded dealer-month
    measures are projections of this aggregate, so the fact is scanned once.
    """
    funded = funded_predicate(case_sensitive=case_sensitive)
    return (fact.where(F.col(date_col).isNotNull())
            .groupBy("dealership_id", month_start(date_col).alias("Funding_MM"))
            .agg(F.count(F.when(funded, F.lit(1))).alias("n_funded"),
                 F.sum(F.when(funded, F.col("count"))).alias("Funded"),
                 F.sum(F.when(funded, F.col("total_financed"))).alias("Orig")))


def from_month(fact: DataFrame, first: dt.date | None, date_col: str = "funding_pending_date") -> DataFrame:
    """Fact rows dated in ``first`` or later; none without a first month (no cohort)."""
    return fact.where(F.lit(False)) if first is None else fact.where(F.col(date_col) >= F.lit(first))


def funded_from_activity(activity: DataFrame) -> DataFrame:
    """Dealer-months with at least one funded row."""
    return activity.where(F.col("n_funded") > 0).select("dealership_id", "Funding_MM", "Funded", "Orig")


def spine_from_activity(activity: DataFrame, as_of: dt.date) -> DataFrame:
    """Months with any fact row up to the last complete month."""
    cut_month = last_complete_day(as_of).replace(day=1)
    return (activity.where(F.col("Funding_MM") <= F.lit(cut_month))
            .select(F.col("Funding_MM").alias("Calendar_MM")).distinct())


def enrolment_cohorts(account: DataFrame, as_of: dt.date,
                      candidate_filter: Column | None = None) -> DataFrame:
    """Treated dealers: enrolled by the cut-off and not unenrolled; M0 and MP1 months."""
    enrolled = to_date_col("prequal_integrated_enrolled_date__c")
    rows = account.where(
        F.col("dealership_id__c").isNotNull()
        & F.col("prequal_integrated_enrolled_date__c").isNotNull()
        & (enrolled <= F.lit(last_complete_day(as_of)))
        & F.col("prequal_integrated_unenrolled_date__c").isNull())
    if candidate_filter is not None:
        rows = rows.where(candidate_filter)
    m0 = F.trunc(enrolled, "MM")
    return rows.select(
        "dealership_id__c", enrolled.alias("Prequal_Int_Enrl_Date"),
        m0.alias("M0"), F.add_months(m0, -1).alias("MP1"))


def cohort_baseline(cohorts: DataFrame, monthly: DataFrame) -> DataFrame:
    """Measures of each treated dealer in its M0 and MP1 months.

    The cohort row is expanded to its two months and equi-joined on
    (dealer, month), so only two monthly rows per dealer are touched.
    """
    months = cohorts.select("dealership_id__c", "M0", "MP1",
                            F.explode(F.array("M0", "MP1")).alias("Funding_MM")).distinct()
    joined = months.join(monthly, (months.dealership_id__c == monthly.dealership_id)
                         & (months.Funding_MM == monthly.Funding_MM))
    return joined.select(
        months.dealership_id__c, "M0", "MP1", months.Funding_MM,
        F.when(months.Funding_MM == F.col("M0"), 1).otherwise(0).alias("M0_ind"),
        F.when(months.Funding_MM == F.col("MP1"), 1).otherwise(0).alias("MP1_ind"),
        "Funded", "Orig")


def mom_growth(m0: Column, mp1: Column) -> Column:
    """Month-over-month growth M0/MP1 - 1, NULL when MP1 <= 0."""
    return F.when(mp1 > 0, m0.cast("double") / mp1.cast("double") - 1)


def growth_profile(cohorts: DataFrame, baseline: DataFrame, size_tol: float = SIZE_TOLERANCE,
                   growth_tols: dict[str, float] = GROWTH_TOLERANCES) -> DataFrame:
    """Per treated dealer: M0/MP1 measures (0 when inactive), growth and bands."""
    base = baseline.groupBy("dealership_id__c", "M0").agg(
        F.sum(F.when(F.col("M0_ind") == 1, F.col("Orig"))).alias("b_m0_orig"),
        F.sum(F.when(F.col("M0_ind") == 1, F.col("Funded"))).alias("b_m0_fund"),
        F.sum(F.when(F.col("MP1_ind") == 1, F.col("Funded"))).alias("b_mp1_fund"))
    prof = (cohorts.join(base, ["dealership_id__c", "M0"], "left")
            .select("dealership_id__c", "Prequal_Int_Enrl_Date", "M0",
                    F.coalesce("b_m0_orig", F.lit(0).cast("decimal(28,2)")).alias("M0_Orig"),
                    F.coalesce("b_m0_fund", F.lit(0).cast("bigint")).alias("M0_Fund"),
                    F.coalesce("b_mp1_fund", F.lit(0).cast("bigint")).alias("MP1_Fund")))
    lo, hi = size_band("M0_Fund", size_tol)
    growth = mom_growth(F.col("M0_Fund"), F.col("MP1_Fund"))
    cols = [
        F.when(F.col("M0_Fund") > 0, 1).otherwise(0).alias("w_M0_Fund_Ind"),
        F.when(F.col("MP1_Fund") > 0, 1).otherwise(0).alias("w_MP1_Fund_Ind"),
        lo.alias("M0_Fund_Min"), hi.alias("M0_Fund_Max"), growth.alias("MP1_Fund_MoM"),
    ]
    for name, tol in growth_tols.items():
        glo, ghi = growth_band(growth, tol)
        cols += [glo.alias(f"MP1_Fund_MoM_Min_{name}"), ghi.alias(f"MP1_Fund_MoM_Max_{name}")]
    return prof.select("*", *cols)


def enrolled_ids(account: DataFrame) -> DataFrame:
    """Ids that ever enrolled in the feature (NULL ids removed, see ``never_enrolled``)."""
    return (account.where(F.col("prequal_integrated_enrolled_date__c").isNotNull()
                          & F.col("dealership_id__c").isNotNull())
            .select(F.col("dealership_id__c").alias("enrolled_id")).distinct())


def never_enrolled(rows: DataFrame, account: DataFrame, id_col: str = "dealership_id") -> DataFrame:
    """Rows whose dealer never enrolled (including enrolled-then-unenrolled).

    ``NOT IN (subquery)`` is null-aware: a NULL among the enrolled ids would
    empty the result and a NULL probe id is always dropped.  Here NULL ids
    are removed from both sides and the rest is a plain anti join, which is
    the intended reading and plans as a hash join at any size.
    """
    ids = enrolled_ids(account)
    return (rows.where(F.col(id_col).isNotNull())
            .join(ids, F.col(id_col) == ids.enrolled_id, "left_anti"))


def cohort_months(cohorts: DataFrame) -> DataFrame:
    """Distinct (M0, MP1) with each of the two months on its own row (bounded: one per month)."""
    return (cohorts.select("M0", "MP1").distinct()
            .select("M0", "MP1", F.explode(F.array(
                F.struct(F.col("M0").alias("month"), F.lit("m0").alias("role")),
                F.struct(F.col("MP1").alias("month"), F.lit("mp1").alias("role")))).alias("cm"))
            .select("M0", "MP1", "cm.month", "cm.role"))


def candidate_profiles(monthly: DataFrame, account: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Never-enrolled dealers' M0/MP1 measures and growth for every cohort month pair.

    Only dealers with activity in the cohort's M0 or MP1 month get a row:
    a dealer inactive in both has measures 0 and can never fall inside a
    size band (its lower end is > 0), so its row would carry no information.
    The month list is broadcast (one row per cohort month) and the join is an
    equi-join on the month, not a cross product with the fact.
    """
    pool = never_enrolled(monthly, account)
    cm = F.broadcast(cohort_months(cohorts))
    rows = pool.join(cm, pool.Funding_MM == cm.month)
    is_m0, is_mp1 = F.col("role") == "m0", F.col("role") == "mp1"
    prof = rows.groupBy("dealership_id", "M0", "MP1").agg(
        F.sum(F.when(is_m0, F.col("Orig"))).alias("m0_orig"),
        F.sum(F.when(is_m0, F.col("Funded"))).alias("m0_fund"),
        F.sum(F.when(is_mp1, F.col("Funded"))).alias("mp1_fund"))
    m0_fund = F.coalesce("m0_fund", F.lit(0).cast("bigint"))
    mp1_fund = F.coalesce("mp1_fund", F.lit(0).cast("bigint"))
    return prof.select(
        "dealership_id", "M0", "MP1",
        F.coalesce("m0_orig", F.lit(0).cast("decimal(28,2)")).alias("M0_Orig"),
        m0_fund.alias("M0_Fund"), mp1_fund.alias("MP1_Fund"),
        mom_growth(m0_fund, mp1_fund).alias("MP1_Fund_MoM"))


def candidate_counts(candidates: DataFrame, cohorts: DataFrame, pool: DataFrame) -> DataFrame:
    """Per cohort month pair: all candidates (the pool), those with business in M0 or MP1, and those without.

    The rows of ``candidate_profiles`` and the counts of the all-zero rows it does not make.
    """
    active = candidates.groupBy("M0", "MP1").agg(F.count(F.lit(1)).alias("n_active"))
    out = cohorts.select("M0", "MP1").distinct().join(active, ["M0", "MP1"], "left")
    n, active = pool.agg(F.count(F.lit(1))).scalar(), F.coalesce("n_active", F.lit(0).cast("bigint"))
    return out.select("M0", "MP1", n.alias("n_candidates"), active.alias("n_active"), (n - active).alias("n_inactive"))


def store_activity(activity: DataFrame, table: str, buckets: int) -> DataFrame:
    """The dealer-month aggregate as a catalog table bucketed by dealer, and that table.

    Joins on the dealer then read it in place: no exchange on its side.  Joins on dealer and month do
    too where ``spark.sql.requireAllClusterKeysForCoPartition`` is off (see ``recommended_conf``).
    """
    (activity.repartition(buckets, "dealership_id").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "dealership_id").sortBy("dealership_id", "Funding_MM").saveAsTable(table))
    return activity.sparkSession.table(table)
