"""Explicit schemas for the eight inputs; nothing is schema-inferred.

``conform`` is applied at the boundary: it checks that every contract column
is present, casts to the contract type and drops everything else, so column
pruning reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, D, S = T.LongType(), T.DateType(), T.StringType()
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CONTRACTS: dict[str, T.StructType] = {
    # one row per funded or pending application, dated by funding date
    "fact_funded": _schema(
        ("dealership_id", L), ("funding_pending_date", D), ("is_funded", S),
        ("count", L), ("total_financed", T.DecimalType(18, 2)),
        ("vehicle_type", S), ("rsm_territory_regions__c", S)),
    # one row per submitted application (all outcomes)
    "fact_apps": _schema(
        ("dealership_id", L), ("submitted_at", D), ("source_client", S),
        ("vehicle_type", S), ("app_type", S), ("rsm_territory_regions__c", S)),
    # current-state dealer dimension, expected unique on dealership_id__c
    "dim_account": _schema(
        ("dealership_id__c", L), ("name", S), ("vertical_type__c", S),
        ("status__c", S), ("powersports_sales_tier__c", S),
        ("rsm_territory_regions__c", S),
        ("prequal_integrated_enrolled_date__c", D),
        ("prequal_integrated_unenrolled_date__c", D),
        ("enrolled_time_stamp__c", TS), ("previous_dealer_id__c", L)),
    # monthly loyalty status with the prior state on the same row
    "status_monthly": _schema(
        ("dealership_id__c", L), ("partition_date", D), ("full_status", S),
        ("full_status_prior", S)),
    "region_rep": _schema(("region", S), ("team", S), ("sales_name", S)),
    "manual_report": _schema(
        ("sales_name", S), ("team", S), ("metric_id", T.IntegerType()),
        ("metric_name", S), ("date", D), ("metric_volume", L), ("note", S)),
    "bounty": _schema(("metric_id", T.IntegerType()), ("team", S),
                      ("bounty_per_unit", L)),
    # daily history of dealer users, partitioned by partition_date
    "user_hist": _schema(
        ("partition_date", D), ("dealership_id", L), ("last_login", TS),
        ("dealer_user_type", S)),
}


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; has {df.columns}")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the named contract (checked, cast, pruned)."""
    schema = CONTRACTS[name]
    require_columns(df, schema.fieldNames(), name)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def require_unique(df: DataFrame, keys: list[str], what: str = "input", show: int = 20) -> None:
    """Fail when ``keys`` repeat, naming up to ``show`` offending keys.

    A distributed aggregation; only the offending keys (at most ``show``)
    come back to the driver.
    """
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    dup = (df.where(present)
           .groupBy(*keys).count().where(F.col("count") > 1).limit(show).collect())
    if dup:
        raise ValueError(f"{what} is not unique on {keys}: {[tuple(r)[:-1] for r in dup]}")


def unique_lookup(df: DataFrame, keys: list[str], what: str = "lookup") -> DataFrame:
    """``df`` with one row per key, for a join that must not repeat its rows.

    The check is part of the plan: a repeated key raises when a column of its row is evaluated, so it
    fails the run that uses the lookup and costs no job of its own.  Rows with a null key match nothing
    and are left out.  The rows are combined by key, which a join on it needs anyway.
    """
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    others = [c for c in df.columns if c not in keys]
    rows = df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in others])
    said = F.concat(F.lit(f"{what} is not unique on {', '.join(keys)}: "),
                    F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return rows.select(*keys, *[F.when(F.col("_rows") == 1, F.col(c)).otherwise(F.raise_error(said)).alias(c)
                                for c in others])
