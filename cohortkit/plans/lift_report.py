"""Peer lift report: matched peers for feature adopters and a dense monthly panel.

Stages:

1. account -> treated cohorts (M0, MP1) and the least MP1, which bounds the fact scan
2. fact -> dealer x month measures (partial + final hash aggregate); the
   only relation that grows with the fact, read once and persisted
3. baseline by equi-join on (dealer, month); never-enrolled candidates: anti
   join + equi-join with the broadcast month list
4. band join of cells on (M0, log-size bucket); adaptive counts by aggregation
5. normaliser and synthetic peer per cell; dense panel, cohort sizes, tenure, names

The fact is scanned once: the dealer-month activity aggregate feeds both the
funded measures and the month spine.  Months before the first MP1 enter neither
(``all_time`` reads them too, for the spine, the measures or the pool alone).  With
``activity_table`` the aggregate is stored bucketed by dealer in the catalog.  Relations
consumed by several later stages (activity, profile, candidates, normaliser) are
persisted (memory and disk; lost blocks are recomputed from lineage).  When the
session names a shared ``spark.checkpoint.dir`` (and ``materialize`` is left on)
the picked cells are checkpointed there instead, cutting the lineage before the
fan-out.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.operators import cohorts as C
from cohortkit.operators import matching as M
from cohortkit.operators import panel as P
from cohortkit.session import checkpoint_dir
from cohortkit.sources.contracts import require_unique


class LiftStages:
    """Every intermediate relation of the lift report, planned on first use."""

    def __init__(self, fact: DataFrame, account: DataFrame, as_of: dt.date, *, low: int = 4,
                 high: int = 10, size_tol: float = C.SIZE_TOLERANCE,
                 growth_tols: dict[str, float] = C.GROWTH_TOLERANCES,
                 candidate_filter: Column | None = None, case_sensitive: bool = False,
                 persist: bool = True, materialize: bool = True, all_time: bool = False,
                 activity_table: str | None = None, buckets: int | None = None):
        self.fact, self.account, self.as_of = fact, account, as_of
        self.all_time, self.activity_table, self.buckets = all_time, activity_table, buckets
        self.low, self.high, self.size_tol, self.growth_tols = low, high, size_tol, growth_tols
        self.candidate_filter, self.case_sensitive = candidate_filter, case_sensitive
        self.persist, self.materialize = persist, materialize
        self._persisted: list[DataFrame] = []

    def validate(self) -> "LiftStages":
        """Check the account is unique per dealer (the joins on the dealer id assume it)."""
        require_unique(self.account.where(F.col("dealership_id__c").isNotNull()),
                       ["dealership_id__c"], "account")
        return self

    def _keep(self, df: DataFrame, checkpoint: bool = False) -> DataFrame:
        """Reuse ``df`` across consumers: reliable checkpoint (shared folder) or persist."""
        if checkpoint and self.materialize and checkpoint_dir(df.sparkSession):
            # persist first: the eager count fills the cache and the checkpoint write
            # reads it, instead of computing the plan a second time
            staged = df.persist(StorageLevel.MEMORY_AND_DISK)
            out = staged.checkpoint(eager=True)
            staged.unpersist()
            return out
        if self.persist:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(df)
        return df

    def release(self) -> None:
        """Drop the persisted intermediates (after the report was written)."""
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()

    @cached_property
    def first_month(self) -> dt.date | None:
        """The least MP1 of all cohorts: no earlier month enters the report.  One row of one small scan."""
        return self.cohorts.agg(F.min("MP1")).first()[0]

    @cached_property
    def activity(self) -> DataFrame:
        fact = self.fact
        if not self.all_time:  # the bound reaches the scan and prunes a fact partitioned by its date
            fact = C.from_month(fact, self.first_month)
        activity = C.dealer_month_activity(fact, case_sensitive=self.case_sensitive)
        if self.activity_table:
            buckets = self.buckets or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return C.store_activity(activity, self.activity_table, buckets)
        return self._keep(activity)

    @cached_property
    def monthly(self) -> DataFrame:
        return C.funded_from_activity(self.activity)

    @cached_property
    def spine(self) -> DataFrame:
        return C.spine_from_activity(self.activity, self.as_of)

    @cached_property
    def cohorts(self) -> DataFrame:
        return C.enrolment_cohorts(self.account, self.as_of, self.candidate_filter)

    @cached_property
    def baseline(self) -> DataFrame:
        return C.cohort_baseline(self.cohorts, self.monthly)

    @cached_property
    def profile(self) -> DataFrame:
        return self._keep(C.growth_profile(self.cohorts, self.baseline, self.size_tol,
                                           self.growth_tols))

    @cached_property
    def candidates(self) -> DataFrame:
        return self._keep(C.candidate_profiles(self.monthly, self.account, self.cohorts))

    @cached_property
    def pool(self) -> DataFrame:
        """Never-enrolled dealers with any funded row in the time read."""
        return C.never_enrolled(self.monthly.select("dealership_id").distinct(), self.account)

    @cached_property
    def pairs(self) -> DataFrame:
        # read by the counts and the selection of ``adaptive``; the report does not use them
        return self._keep(M.match_pairs(self.profile, self.candidates, self.size_tol, self.growth_tols))

    @cached_property
    def adaptive(self) -> DataFrame:
        return M.adaptive_peers(self.pairs, self.low, self.high)

    @cached_property
    def picked(self) -> DataFrame:
        return self._keep(M.picked_cells(self.profile, self.candidates, self.low, self.high, self.size_tol,
                                         self.growth_tols), checkpoint=True)

    @cached_property
    def selected(self) -> DataFrame:
        # the pairs, for a report of them; the lift takes the cells
        return M.select_peers(self.profile, self.candidates, self.picked)

    @cached_property
    def normaliser(self) -> DataFrame:
        return self._keep(M.cell_normaliser(self.profile, self.candidates, self.picked))

    @cached_property
    def peer_months(self) -> DataFrame:
        return P.peer_monthly(self.selected, self.monthly)

    @cached_property
    def cell_months(self) -> DataFrame:
        return P.cell_months(M.picked_members(self.candidates, self.picked), self.picked, self.monthly)

    @cached_property
    def synthetic(self) -> DataFrame:
        return P.synthetic_peer(self.cell_months, self.profile, self.normaliser)

    @cached_property
    def panel(self) -> DataFrame:
        return P.dense_panel(self.normaliser, self.spine, self.as_of)

    @cached_property
    def filled(self) -> DataFrame:
        return P.fill_panel(self.panel, self.monthly)

    @cached_property
    def sizes(self) -> DataFrame:
        return P.cohort_sizes(self.normaliser)

    @cached_property
    def tenure(self) -> DataFrame:
        return P.cohort_tenure(self.cohorts, self.spine, self.as_of)

    @cached_property
    def lift_panel(self) -> DataFrame:
        return P.with_tenure(P.lift_panel(self.filled, self.synthetic, self.sizes), self.tenure)

    @cached_property
    def report(self) -> DataFrame:
        return P.attach_account(self.lift_panel, self.account)


def lift_stages(fact: DataFrame, account: DataFrame, as_of: dt.date, **kwargs) -> LiftStages:
    return LiftStages(fact, account, as_of, **kwargs)


def peer_lift_report(fact: DataFrame, account: DataFrame, as_of: dt.date, **kwargs) -> DataFrame:
    """The 15-column lift panel (cohort x dealer x calendar month)."""
    return lift_stages(fact, account, as_of, **kwargs).report
