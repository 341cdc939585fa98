"""Session helpers used by tests and the benchmark.

Library operators never create a session; they take DataFrames.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "cohortkit") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UI off, UTC)."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("COHORTKIT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any.

    Reads ``spark.checkpoint.dir`` from the session; never invents a
    machine-local folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return conf
    return None


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share, for intermediates that must be read again.

    It is the cluster's ``spark.checkpoint.dir``.  Only a session in one
    process (master ``local``), where a folder of this machine is shared by
    itself, gets one of its own; on a cluster without the setting this fails.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortkit-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def recommended_conf(input_bytes: int, cores: int, target_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the input volume (bytes of the largest fact read by a program).

    Shuffle partitions start at about one per ``target_bytes`` of input (at
    least 2 per core) and AQE coalesces them down or splits skewed ones; file
    splits match the same target so each task's slice fits executor memory.
    """
    parts = max(2 * cores, -(-input_bytes // target_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        # a table bucketed by dealer serves joins on dealer and month without an exchange
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        # checkpointed intermediates are removed from the shared folder once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
