"""Hand-made inputs for the operator tests (small, built in the test session)."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from cohortkit.sources.contracts import CONTRACTS

D = dt.date


def frame(spark, name, rows):
    return spark.createDataFrame(rows, CONTRACTS[name])


def fact_row(dealer, day, count=1, amount="100.00", funded="Yes", vehicle="ATV", region="WEST"):
    return (dealer, day, funded, count, Decimal(amount), vehicle, region)


def account_row(dealer, name=None, tier="A1", region="WEST", prequal=None, unenrolled=None,
                enrolled_ts=None, prev=None, vertical="Powersports"):
    return (dealer, name or f"dealer {dealer}", vertical, "Active", tier, region, prequal, unenrolled,
            enrolled_ts, prev)


def random_peer_world(seed=11, n_treated=9, n_cand=400):
    """Treated dealers in three cohort months and a candidate pool with random monthly counts.

    Pool densities differ per cohort so that every branch of the adaptive
    rule (< low, between, > high) occurs.
    """
    rnd = random.Random(seed)
    cohorts = [D(2021, 3, 1), D(2021, 6, 1), D(2021, 9, 1)]
    facts, accounts = [], []
    treated = {}
    for i in range(n_treated):
        m0 = cohorts[i % 3]
        mp1 = D(m0.year, m0.month - 1, 1)
        dealer = 1000 + i
        m0_n, mp1_n = (20, 20) if i % 3 == 0 else (rnd.randint(8, 40), rnd.randint(5, 40))
        treated[dealer] = (m0, mp1, m0_n, mp1_n)
        accounts.append(account_row(dealer, prequal=D(m0.year, m0.month, 12)))
        facts.append(fact_row(dealer, D(m0.year, m0.month, 3), count=m0_n, amount=f"{m0_n * 1000}.50"))
        facts.append(fact_row(dealer, D(mp1.year, mp1.month, 20), count=mp1_n, amount="10.00"))
        facts.append(fact_row(dealer, D(2021, 12, 5), count=rnd.randint(1, 30), amount="77.00"))
    for j in range(n_cand):
        dealer = 5000 + j
        if j % 50 == 0:
            accounts.append(account_row(dealer, prequal=D(2020, 1, 5), unenrolled=D(2020, 6, 1)))
        elif j % 3 == 0:
            accounts.append(account_row(dealer))
        for month in range(1, 13):
            if rnd.random() < 0.8:
                n = rnd.randint(6, 45) if j % 4 else rnd.randint(18, 22)
                facts.append(fact_row(dealer, D(2021, month, rnd.randint(1, 28)), count=n,
                                      amount=f"{n * 997}.25",
                                      funded=rnd.choice(["Yes", "YES", "yes", "No"])))
    # an id-less account row that enrolled: must not empty the candidate pool
    accounts.append(account_row(None, prequal=D(2021, 1, 5)))
    return facts, accounts, treated
