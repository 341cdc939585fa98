"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from cohortkit.functions.bands import growth_band, size_band
from cohortkit.functions.dates import (add_months_py, month_diff, month_later, month_start,
                                       report_grid, to_date_col, year_before)
from cohortkit.functions.predicates import (level_up, tier_label, tier_prefix,
                                            vehicle_class_filter)

__all__ = [
    "add_months_py", "growth_band", "level_up", "month_diff", "month_later",
    "month_start", "report_grid", "size_band", "tier_label", "tier_prefix",
    "to_date_col", "vehicle_class_filter", "year_before",
]
