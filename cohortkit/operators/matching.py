"""Peer matching: band join, adaptive selection and the normaliser.

The source program pairs every treated dealer with every candidate of the
same cohort month and counts flags with window functions over those pairs.
Here only pairs that can be selected are ever produced:

* a pair needs the candidate inside the size band and inside the widest
  growth band (the three growth bands are nested), so the join is an
  equi-join on (M0, log-size bucket) with the exact bands as residual
  predicates -- a hash join whose output is the candidate set itself;
* per-dealer counts come from one hash aggregation (partial combine, safe
  under a hot dealer) and are joined back on (M0, dealer), instead of a
  window that would hold every pair of a dealer in one task;
* the lift never makes pairs of dealers: all dealers with the same measures
  (a *cell*) have the same peers, so peers are summed per cell.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.cohorts import GROWTH_TOLERANCES, SIZE_TOLERANCE

BUCKET_SLACK = 1e-9


def size_bucket(col, ratio: float):
    """``floor(ln(x) / ln(ratio))``: a band [x(1-t), x(1+t)] spans at most 2 buckets."""
    x = F.col(col) if isinstance(col, str) else col
    return F.floor(F.log(x.cast("double")) / F.lit(math.log(ratio))).cast("int")


def match_cells(profile: DataFrame, candidates: DataFrame, size_tol: float = SIZE_TOLERANCE,
                growth_tols: dict[str, float] = GROWTH_TOLERANCES) -> DataFrame:
    """Treated cells x candidate cells of the same M0 inside the size and widest growth band.

    The bands depend on (M0, M0_Fund, MP1_Fund_MoM) only, so all dealers with the same three are
    one cell.  Output: the two cells, ``n`` candidates in the candidate cell, and the
    band flags of every tolerance.  The join is on (M0, log-size bucket) of distinct cells, so its
    work does not grow with the dealers of a crowded size.
    """
    ratio = (1 + size_tol) / (1 - size_tol)
    widest = max(growth_tols, key=growth_tols.get)
    lo_w, hi_w = f"MP1_Fund_MoM_Min_{widest}", f"MP1_Fund_MoM_Max_{widest}"
    bands = ["M0_Fund_Min", "M0_Fund_Max", *[f"MP1_Fund_MoM_{side}_{name}" for name in growth_tols
                                             for side in ("Min", "Max")]]
    treated = (profile.where(F.col("M0_Fund_Min").isNotNull() & F.col(lo_w).isNotNull())
               .groupBy(*TREATED_CELL).agg(*[F.min(b).alias(b) for b in bands])
               .withColumn("bucket", F.explode(F.sequence(
                   size_bucket(F.col("M0_Fund_Min") * (1 - BUCKET_SLACK), ratio),
                   size_bucket(F.col("M0_Fund_Max") * (1 + BUCKET_SLACK), ratio)))))
    cand = (_matchable(candidates).groupBy("M0", *PEER_CELL)
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bucket", size_bucket("Peer_M0_Fund", ratio)))
    growth = F.col("Peer_MP1_Fund_MoM")
    cells = treated.join(cand, ["M0", "bucket"]).where(
        F.col("Peer_M0_Fund").between(F.col("M0_Fund_Min"), F.col("M0_Fund_Max"))
        & growth.between(F.col(lo_w), F.col(hi_w)))
    flags = [F.when(growth.between(F.col(f"MP1_Fund_MoM_Min_{name}"), F.col(f"MP1_Fund_MoM_Max_{name}")), 1)
             .otherwise(0).alias(f"within_MP1_Fund_MoM_{name}") for name in growth_tols]
    return cells.select(*TREATED_CELL, *PEER_CELL, "n", *flags)


TREATED_CELL = ["M0", "M0_Fund", "MP1_Fund_MoM"]
PEER_CELL = ["Peer_M0_Fund", "Peer_MP1_Fund_MoM"]


def _matchable(candidates: DataFrame) -> DataFrame:
    return (candidates.where((F.col("M0_Fund") > 0) & F.col("MP1_Fund_MoM").isNotNull())
            .select("M0", F.col("dealership_id").alias("Peer_Dealership_id"),
                    F.col("M0_Orig").alias("Peer_M0_Orig"), F.col("M0_Fund").alias("Peer_M0_Fund"),
                    F.col("MP1_Fund").alias("Peer_MP1_Fund"),
                    F.col("MP1_Fund_MoM").alias("Peer_MP1_Fund_MoM")))


def match_pairs(profile: DataFrame, candidates: DataFrame, size_tol: float = SIZE_TOLERANCE,
                growth_tols: dict[str, float] = GROWTH_TOLERANCES) -> DataFrame:
    """Treated x candidate pairs of the same M0 inside the size and widest growth band.

    Output: one row per pair with the band flags of every tolerance and the
    first-pass flag ``Peer_Sel_1_Ind`` (size and first growth band).  All of
    them are wanted only as a report; the lift takes ``picked_cells``.
    """
    first = next(iter(growth_tols))
    cells = match_cells(profile, candidates, size_tol, growth_tols).drop("n")
    pairs = profile.join(cells, TREATED_CELL).join(_matchable(candidates), ["M0", *PEER_CELL])
    return (pairs.withColumn("within_M0_Fund_Ind", F.lit(1))
            .withColumn("Peer_Sel_1_Ind", F.col(f"within_MP1_Fund_MoM_{first}")))


def match_cell_counts(profile: DataFrame, candidates: DataFrame, pool: DataFrame, size_tol: float = SIZE_TOLERANCE,
                      growth_tols: dict[str, float] = GROWTH_TOLERANCES, narrow: str = "2H",
                      first: str = "1") -> DataFrame:
    """All treated dealers against all candidates of their M0, counted by cells: the whole relation, no pairs.

    A row with ``selectable`` 1 is a treated cell and a peer cell inside its size band and widest
    growth band, with the flags of the other bands, the number of dealers and of peers.  A row with
    ``selectable`` 0 counts the treated cell's other candidates: every dealer of ``pool`` (one row per
    never-enrolled dealer) is a candidate of every M0, also without business in it, so they are the
    pool less the peers inside.  A treated cell that has no candidate at all keeps such a row, with 0 peers.
    """
    cells = match_cells(profile, candidates, size_tol, growth_tols)
    dealers = profile.groupBy(*TREATED_CELL).agg(F.count(F.lit(1)).alias("n_dealers"))
    flags = [f"within_MP1_Fund_MoM_{first}", f"within_MP1_Fund_MoM_{narrow}"]
    inside = cells.join(dealers, TREATED_CELL).select(
        *TREATED_CELL, F.lit(1).alias("selectable"), *PEER_CELL, *flags, "n_dealers", F.col("n").alias("n_peers"))
    held = cells.groupBy(*TREATED_CELL).agg(F.sum("n").alias("_held"))
    size = pool.agg(F.count(F.lit(1))).scalar()
    rest = dealers.join(held, TREATED_CELL, "left").select(
        *TREATED_CELL, F.lit(0).alias("selectable"), *[F.lit(None).cast(t).alias(c) for c, t in (
            (PEER_CELL[0], "bigint"), (PEER_CELL[1], "double"), (flags[0], "int"), (flags[1], "int"))],
        "n_dealers", (size - F.coalesce("_held", F.lit(0))).alias("n_peers"))
    return inside.unionByName(rest.where((F.col("n_peers") > 0) | (size == 0)))


def picked_cells(profile: DataFrame, candidates: DataFrame, low: int = 4, high: int = 10,
                 size_tol: float = SIZE_TOLERANCE, growth_tols: dict[str, float] = GROWTH_TOLERANCES,
                 narrow: str = "2H", wide: str = "2L", first: str = "1") -> DataFrame:
    """(treated cell, peer cell) of the final selection, with ``n`` candidates in the peer cell.

    Each treated cell counts its candidates per band and picks the band (the rule of
    ``adaptive_peers``).  All dealers of a treated cell have the same peers: every candidate of
    its picked peer cells.
    """
    cells = match_cells(profile, candidates, size_tol, growth_tols)
    flag = lambda name: F.col(f"within_MP1_Fund_MoM_{name}")
    counts = cells.groupBy(*TREATED_CELL).agg(F.sum(F.col("n") * flag(first)).alias("_n_first"))
    return cells.join(counts, TREATED_CELL).where(
        F.when(F.col("_n_first") < low, flag(wide)).when(F.col("_n_first") > high, flag(narrow))
        .otherwise(flag(first)) == 1).select(*TREATED_CELL, *PEER_CELL, "n")


def select_peers(profile: DataFrame, candidates: DataFrame, picked: DataFrame) -> DataFrame:
    """(M0, dealer, peer) of the final selection, with the peer's M0 measures.

    Dealers are joined only for the picked cells, so no pair is made that is not selected.  The
    lift itself needs no pairs: see ``cell_normaliser`` and ``panel.cell_months``.
    """
    dealers = profile.select(*TREATED_CELL, "dealership_id__c")
    return (dealers.join(picked.drop("n"), TREATED_CELL).join(_matchable(candidates), ["M0", *PEER_CELL])
            .select("M0", "dealership_id__c", "Peer_Dealership_id", "Peer_M0_Orig", "Peer_M0_Fund"))


def adaptive_peers(pairs: DataFrame, low: int = 4, high: int = 10,
                   narrow: str = "2H", wide: str = "2L", first: str = "1") -> DataFrame:
    """Second pass: pick the growth band from the first-pass peer count.

    count < low  -> wide band;  count > high -> narrow band;  else first band.
    Adds ``Peer_Cnt_Sel_1``, ``Peer_Sel_2_Ind`` (= ``Peer_Sel_Final_Ind``) and
    ``Peer_Cnt_Final`` to every pair.
    """
    keys = ["M0", "dealership_id__c"]
    counts = pairs.groupBy(*keys).agg(
        F.sum("Peer_Sel_1_Ind").alias("Peer_Cnt_Sel_1"),
        F.sum(f"within_MP1_Fund_MoM_{wide}").alias("_n_wide"),
        F.sum(f"within_MP1_Fund_MoM_{narrow}").alias("_n_narrow"))
    cnt1 = F.col("Peer_Cnt_Sel_1")
    counts = counts.select(
        *keys, "Peer_Cnt_Sel_1",
        F.when(cnt1 < low, F.col("_n_wide")).when(cnt1 > high, F.col("_n_narrow"))
        .otherwise(cnt1).alias("Peer_Cnt_Final"))
    out = pairs.join(counts, keys)
    sel2 = (F.when((cnt1 < low) & (F.col(f"within_MP1_Fund_MoM_{wide}") == 1), 1)
            .when((cnt1 > high) & (F.col(f"within_MP1_Fund_MoM_{narrow}") == 1), 1)
            .when(cnt1.between(low, high) & (F.col(f"within_MP1_Fund_MoM_{first}") == 1), 1)
            .otherwise(0))
    return (out.withColumn("Peer_Sel_2_Ind", sel2)
            .withColumn("Peer_Sel_Final_Ind", F.col("Peer_Sel_2_Ind")))


def selected_peers(adaptive: DataFrame) -> DataFrame:
    """(M0, dealer, peer) of the final selection, with the peer's M0 measures."""
    return (adaptive.where(F.col("Peer_Sel_Final_Ind") == 1)
            .select("M0", "dealership_id__c", "Peer_Dealership_id", "Peer_M0_Orig", "Peer_M0_Fund"))


def peer_normaliser(profile: DataFrame, selected: DataFrame) -> DataFrame:
    """The normaliser from pairs: per treated dealer, its peers counted and summed at M0."""
    keys = ["M0", "dealership_id__c"]
    tot = selected.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("Peer_M0_Orig").alias("Peer_tot_M0_Orig"),
        F.sum("Peer_M0_Fund").alias("Peer_tot_M0_Fund"))
    return _with_ratios(profile.select(*keys, "M0_Orig", "M0_Fund", "MP1_Fund").join(tot, keys, "left"))


def cell_normaliser(profile: DataFrame, candidates: DataFrame, picked: DataFrame) -> DataFrame:
    """The normaliser from cells: each picked peer cell is summed once, each treated cell once over
    its peer cells, and dealers take the totals of their cell.  No pair of dealers is made.
    """
    sums = _matchable(candidates).join(picked.select("M0", *PEER_CELL).distinct(), ["M0", *PEER_CELL]) \
        .groupBy("M0", *PEER_CELL).agg(F.count(F.lit(1)).alias("_cell_n"), F.sum("Peer_M0_Orig").alias("_cell_orig"),
                                       F.sum("Peer_M0_Fund").alias("_cell_fund"))
    tot = picked.join(sums, ["M0", *PEER_CELL]).groupBy(*TREATED_CELL).agg(
        F.sum("_cell_n").alias("_n"), F.sum("_cell_orig").cast("decimal(38,2)").alias("Peer_tot_M0_Orig"),
        F.sum("_cell_fund").alias("Peer_tot_M0_Fund"))
    dealers = profile.select(*TREATED_CELL, "dealership_id__c", "M0_Orig", "MP1_Fund")
    return _with_ratios(dealers.join(tot, TREATED_CELL, "left").select(
        "M0", "dealership_id__c", "M0_Orig", "M0_Fund", "MP1_Fund", "_n", "Peer_tot_M0_Orig", "Peer_tot_M0_Fund"))


def _with_ratios(totals: DataFrame) -> DataFrame:
    """Per treated dealer: peer count, has-peer flag, peer totals at M0 and one ratio per measure.

    Every treated dealer keeps its row; without peers the count is 0 and the
    totals and ratios are NULL.
    """
    has = F.col("w_Peer_Ind") == 1
    return (totals.withColumn("Peer_Cnt", F.coalesce("_n", F.lit(0).cast("bigint")))
            .withColumn("w_Peer_Ind", F.when(F.col("Peer_Cnt") > 0, 1).otherwise(0))
            .withColumn("Norm_Ratio_Orig", F.when(has & (F.col("M0_Orig") > 0),
                        F.col("Peer_tot_M0_Orig").cast("double") / F.col("M0_Orig").cast("double")))
            .withColumn("Norm_Ratio_Fund", F.when(has & (F.col("M0_Fund") > 0),
                        F.col("Peer_tot_M0_Fund").cast("double") / F.col("M0_Fund").cast("double")))
            .drop("_n"))


def picked_members(candidates: DataFrame, picked: DataFrame) -> DataFrame:
    """(M0, peer cell, peer) of the candidates in cells that some treated cell picked."""
    wanted = picked.select("M0", *PEER_CELL).distinct()
    return _matchable(candidates).join(wanted, ["M0", *PEER_CELL], "left_semi").select(
        "M0", *PEER_CELL, "Peer_Dealership_id")
