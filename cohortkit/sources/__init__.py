"""Input contracts and source views."""

from cohortkit.sources.contracts import CONTRACTS, conform, require_columns, require_unique

__all__ = ["CONTRACTS", "conform", "require_columns", "require_unique"]
