"""Fixed values of the fixture, as the oracle's own text (they must equal the ones the queries run with)."""

from datetime import date

AS_OF = date(2002, 1, 1)
CONTEST_START, CONTEST_END = date(1998, 2, 1), date(1998, 3, 31)
LOOKBACK_START, SHORT_LOOKBACK = date(1997, 1, 1), date(1998, 1, 1)
ENROL_FLOOR = date(1998, 1, 1)
LEVEL_DATES = (date(1998, 2, 1), date(1998, 3, 1))
FEATURE_WINDOW_WIDE = (date(1996, 2, 1), date(1996, 12, 31))
FLEX_LAUNCH = date(1998, 1, 1)
NEWCOMER_START = date(1998, 2, 10)
GRID_FIRST, GRID_LAST, GRID_STEP = date(1995, 1, 1), date(2001, 8, 1), 1
REP_REGION_OVERRIDES = {"rsm_asia": "South"}
EXCLUDED_REPS = ("bdr_africa",)
BOUNTY_ROWS = (
    ("RSM", 4, 20000), ("RSM", 5, 30000), ("RSM", 6, 25000), ("RSM", 7, 50000), ("RSM", 8, 10000),
    ("RSM", 10, 500), ("RSM", 13, 100), ("BDR", 2, 25000), ("BDR", 3, 15000), ("BDR", 4, 20000),
    ("BDR", 5, 40000), ("BDR", 6, 30000), ("BDR", 7, 50000), ("BDR", 9, 20000), ("BDR", 11, 300))
