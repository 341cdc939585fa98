"""Independent DuckDB SQL oracles for every registered query.

Written as plain SQL over the driver's pre-registered views (region nation
customer supplier part orders lineitem ...); nothing here calls the library.
Only fixture parameters (dates, lookups) are shared.
"""
