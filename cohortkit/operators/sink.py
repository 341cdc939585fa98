"""Result sinks: create or replace a result as a whole, append to it, or replace only the partitions written.

A replaced result is written next to the old one first and takes its place by renaming, so a failed
write leaves the old result as it was, and a result may be computed from itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_result(df: DataFrame, path: str | None = None, *, table: str | None = None,
                 mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                 fmt: str = "parquet") -> None:
    """Write a result table.

    ``mode='overwrite'`` replaces the result by a staged write and a swap.  With
    ``partition_by`` it replaces only the partitions present in ``df`` (dynamic
    partition overwrite), so re-running one report date is idempotent and leaves
    the other dates in place.  ``append`` adds rows.  Give either a shared ``path``
    or a catalog ``table``.  A partitioned table that exists already is inserted
    into, its columns matched by name: saving it anew would replace all of its
    partitions.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is overwrite or append, not {mode!r}")
    exists = table is not None and df.sparkSession.catalog.tableExists(table)
    if exists and (partition_by or mode == "append"):
        _insert(df, table, overwrite=mode == "overwrite")
    elif mode == "overwrite" and not partition_by:
        replace_path(df, path, fmt) if table is None else replace_table(df, table, fmt)
    else:
        writer = df.write.format(fmt).mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.save(path) if table is None else writer.saveAsTable(table)


def replace_path(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write ``df`` beside ``path``, then rename it into place; the old result goes last."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(fmt).save(staged)
        swap_paths(df.sparkSession, staged, path)
    finally:
        drop_path(df.sparkSession, staged)


def drop_path(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete()


def path_exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists()


def swap_paths(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``.  If that fails, the old folder is put back."""
    new, target = _files(spark, staged), _files(spark, path.rstrip("/"))
    old = _files(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = target.exists()
    if had and not target.rename(old):
        raise OSError(f"{path} could not be moved aside")
    if not new.rename(target):
        if had and not old.rename(target):
            raise OSError(f"{path} could not be replaced; the old result is {old.name}")
        raise OSError(f"{path} could not be replaced; it is as it was")
    old.delete()


def replace_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Save ``df`` under another name of the same database, then rename it; the old table goes last."""
    spark, tag = df.sparkSession, uuid.uuid4().hex[:12]
    staged, old = f"{table}__staged_{tag}", f"{table}__old_{tag}"
    try:
        df.write.format(fmt).saveAsTable(staged)
        had = spark.catalog.tableExists(table)
        if had:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        except Exception:
            if had:
                spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
        if had:
            spark.sql(f"DROP TABLE {old}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")


class _files:
    """A folder in whatever store the session's Hadoop configuration reaches."""

    def __init__(self, spark: SparkSession, name: str):
        self.name = name
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def rename(self, to: "_files") -> bool:
        return self.fs.rename(self.path, to.path)

    def delete(self) -> None:
        self.fs.delete(self.path, True)


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    columns = spark.table(table).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns of {table} are {columns}, not {df.columns}")
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*columns).write.insertInto(table, overwrite=overwrite)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
