import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortkit.operators import cohorts as C
from cohortkit.operators import matching as M
from cohortkit.plans.lift_report import lift_stages
from tests.fixtures import D, frame, random_peer_world

AS_OF = D(2022, 1, 15)


def brute_force_selection(facts, accounts, low, high):
    """Reference semantics written plainly: all pairs per cohort month, then the adaptive rule."""
    monthly = defaultdict(int)
    for dealer, day, funded, count, _amt, _v, _r in facts:
        if day is not None and funded.lower() == "yes":
            monthly[(dealer, day.replace(day=1))] += count
    ever = {a[0] for a in accounts if a[6] is not None and a[0] is not None}
    treated = {}
    for a in accounts:
        if a[0] is not None and a[6] is not None and a[7] is None and a[6] <= AS_OF.replace(day=1):
            m0 = a[6].replace(day=1)
            mp1 = (m0 - dt.timedelta(days=1)).replace(day=1)
            treated[a[0]] = (m0, mp1)
    pool = {f[0] for f in facts if f[0] is not None and f[2].lower() == "yes" and f[0] not in ever}

    def growth(m0, mp1):
        return m0 / mp1 - 1 if mp1 > 0 else None

    def band(g, t):
        if g is None:
            return None
        if g > 0:
            return g * (1 - t), g * (1 + t)
        if g < 0:
            return g * (1 + t), g * (1 - t)
        return -t, t

    def inside(x, b):
        return b is not None and x is not None and b[0] <= x <= b[1]

    selected, counts = set(), {}
    for dealer, (m0, mp1) in treated.items():
        f0, f1 = monthly[(dealer, m0)], monthly[(dealer, mp1)]
        g = growth(f0, f1)
        size = (f0 * 0.75, f0 * 1.25) if f0 > 0 else None
        pairs = []
        for peer in pool:
            p0, p1 = monthly[(peer, m0)], monthly[(peer, mp1)]
            pg = growth(p0, p1)
            flags = {n: inside(p0, size) and inside(pg, band(g, t))
                     for n, t in {"1": 0.10, "2L": 0.50, "2H": 0.05}.items()}
            pairs.append((peer, flags))
        cnt1 = sum(f["1"] for _, f in pairs)
        key = "2L" if cnt1 < low else "2H" if cnt1 > high else "1"
        chosen = {peer for peer, f in pairs if f[key]}
        counts[dealer] = (cnt1, len(chosen))
        selected |= {(m0, dealer, peer) for peer in chosen}
    return selected, counts


@pytest.mark.parametrize("low,high", [(4, 10), (2, 3), (6, 8)])
def test_adaptive_matching_equals_all_pairs(spark, low, high):
    facts, accounts, _ = random_peer_world()
    fact, account = frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts)
    st = lift_stages(fact, account, AS_OF, low=low, high=high)
    got_sel = {(r.M0, r.dealership_id__c, r.Peer_Dealership_id) for r in st.selected.collect()}
    norm = {r.dealership_id__c: r.Peer_Cnt for r in st.normaliser.collect()}
    counts = {r.dealership_id__c: r.Peer_Cnt_Sel_1 for r in
              st.adaptive.select("dealership_id__c", "Peer_Cnt_Sel_1").distinct().collect()}
    want_sel, want_counts = brute_force_selection(facts, accounts, low, high)
    assert got_sel == want_sel
    assert norm == {d: c[1] for d, c in want_counts.items()}
    assert all(counts.get(d, 0) == c[0] for d, c in want_counts.items())
    if (low, high) in ((2, 3), (4, 10)):   # every branch of the rule is exercised
        firsts = [c[0] for c in want_counts.values()]
        assert any(c < low for c in firsts) and any(c > high for c in firsts)
        assert any(low <= c <= high for c in firsts)


def test_null_enrolled_id_does_not_empty_pool(spark):
    facts, accounts, _ = random_peer_world()
    fact, account = frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts)
    dealers = fact.select("dealership_id").distinct()
    assert C.never_enrolled(dealers, account).count() > 0
    # the literal NOT IN form is null-aware and returns nothing when the set holds a NULL
    fact.createOrReplaceTempView("t_fact")
    account.createOrReplaceTempView("t_acc")
    raw = spark.sql("SELECT DISTINCT dealership_id FROM t_fact WHERE dealership_id NOT IN "
                    "(SELECT dealership_id__c FROM t_acc WHERE prequal_integrated_enrolled_date__c IS NOT NULL)")
    assert raw.count() == 0


def test_unenrolled_dealer_is_neither_treated_nor_candidate(spark):
    facts, accounts, _ = random_peer_world()
    fact, account = frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts)
    st = lift_stages(fact, account, AS_OF)
    unenrolled = {a[0] for a in accounts if a[7] is not None}
    assert not unenrolled & {r.dealership_id__c for r in st.cohorts.collect()}
    assert not unenrolled & {r.dealership_id for r in st.candidates.collect()}


def test_report_shape_and_synthetic_peer_at_m0(spark):
    facts, accounts, treated = random_peer_world()
    fact, account = frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts)
    st = lift_stages(fact, account, AS_OF, low=2, high=3)
    rep = st.report
    assert rep.columns == ["M0", "M0_Tenure", "M0_PrequalD_Cnt", "M0_PrequalD_wPeer_Cnt",
                           "Dealership_ID", "Dealership_Name", "w_Peer_Ind", "Peer_Cnt",
                           "Dealership_Tier", "Calendar_MM", "MM", "Funding", "Orig",
                           "Funding_Peer", "Orig_Peer"]
    rows = rep.collect()
    # every treated dealer keeps its rows, with or without peers
    assert {r.Dealership_ID for r in rows} == set(treated)
    # the synthetic peer equals the dealer at M0
    for r in rows:
        if r.MM == 0 and r.w_Peer_Ind == 1:
            assert r.Funding_Peer == pytest.approx(r.Funding, rel=1e-9)
            assert r.Orig_Peer == pytest.approx(r.Orig, rel=1e-9)
    # dense panel: no gaps from M0 to the last complete month
    by_dealer = defaultdict(list)
    for r in rows:
        by_dealer[r.Dealership_ID].append(r.MM)
    for mms in by_dealer.values():
        assert sorted(mms) == list(range(len(mms)))


@pytest.mark.parametrize("tol", [0.05, 0.25, 0.4, 0.6])
def test_bucketed_band_join_finds_every_pair(spark, tol):
    """Size bands around integers of every magnitude: bucketed join == brute force."""
    import random
    from cohortkit.functions.bands import growth_band, size_band
    rnd = random.Random(int(tol * 100))
    m0 = D(2021, 3, 1)
    sizes = [rnd.choice([1, 2, 3, 4, 5, 7, 8, 12, 13, 16, 20, 47, 48, 80, 1000, 1001, 10**9 + 7])
             for _ in range(80)]
    treated = spark.createDataFrame([(i, m0, s, 0.0) for i, s in enumerate(sizes)],
                                    "dealership_id__c long, M0 date, M0_Fund long, MP1_Fund_MoM double")
    lo, hi = size_band("M0_Fund", tol)
    cols = [lo.alias("M0_Fund_Min"), hi.alias("M0_Fund_Max")]
    for name, t in C.GROWTH_TOLERANCES.items():
        glo, ghi = growth_band("MP1_Fund_MoM", t)
        cols += [glo.alias(f"MP1_Fund_MoM_Min_{name}"), ghi.alias(f"MP1_Fund_MoM_Max_{name}")]
    treated = treated.select("*", *cols)
    cands = spark.createDataFrame(
        [(100 + j, m0, Decimal("1.00"), s, 1, 0.0) for j, s in enumerate(sizes)],
        "dealership_id long, M0 date, M0_Orig decimal(28,2), M0_Fund long, MP1_Fund long, MP1_Fund_MoM double")
    got = {(r.dealership_id__c, r.Peer_Dealership_id)
           for r in M.match_pairs(treated, cands, size_tol=tol).collect()}
    want = {(i, 100 + j) for i, s in enumerate(sizes) for j, c in enumerate(sizes)
            if s * (1 - tol) <= c <= s * (1 + tol)}
    assert want
    assert got == want


def test_duplicate_account_rows_are_rejected(spark):
    facts, accounts, _ = random_peer_world()
    accounts = accounts + [accounts[0]]
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts), AS_OF)
    with pytest.raises(ValueError, match="not unique"):
        st.validate()


def test_empty_fact_gives_empty_report(spark):
    _, accounts, _ = random_peer_world()
    st = lift_stages(frame(spark, "fact_funded", []), frame(spark, "dim_account", accounts), AS_OF)
    assert st.report.count() == 0 and st.normaliser.where("Peer_Cnt > 0").count() == 0


def test_inactive_previous_month_and_zero_origination_peers(spark):
    from tests.fixtures import account_row, fact_row
    m0 = D(2021, 3, 1)
    facts = [fact_row(1, D(2021, 3, 2), count=10, amount="500.00"),          # MP1 = 0: no growth
             fact_row(2, D(2021, 3, 2), count=10, amount="500.00"),
             fact_row(2, D(2021, 2, 2), count=10, amount="500.00"),
             fact_row(3, D(2021, 3, 9), count=10, amount="0.00"),            # peer without origination
             fact_row(3, D(2021, 2, 9), count=10, amount="0.00"),
             fact_row(3, D(2021, 4, 9), count=4, amount="0.00")]
    accounts = [account_row(1, prequal=D(2021, 3, 5)), account_row(2, prequal=D(2021, 3, 7)),
                account_row(3)]
    st = lift_stages(frame(spark, "fact_funded", facts), frame(spark, "dim_account", accounts), AS_OF)
    norm = {r.dealership_id__c: r for r in st.normaliser.collect()}
    assert norm[1].Peer_Cnt == 0 and norm[1].w_Peer_Ind == 0 and norm[1].Norm_Ratio_Fund is None
    assert norm[2].Peer_Cnt == 1 and norm[2].Norm_Ratio_Orig == 0.0 and norm[2].Norm_Ratio_Fund == 1.0
    rows = {(r.Dealership_ID, r.Calendar_MM): r for r in st.report.collect()}
    april = rows[(2, D(2021, 4, 1))]
    assert april.Funding_Peer == 4.0 and april.Orig_Peer is None      # 0 ratio: no division
    assert rows[(1, m0)].Funding_Peer is None and rows[(1, m0)].Funding == 10
