"""Session defaults and the shared scratch location.

Scratch data (landing files written for tests, lineage cuts) always goes under
the cluster's ``spark.checkpoint.dir``; a local default is set only where the
session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster run wants as well: AQE re-plans joins and partition counts
# from runtime sizes and splits skewed join partitions.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# Starting points for a large cluster (hundreds of executors, tens of TB per run).
# AQE coalesces the initial shuffle partitions down to the advisory size, so the
# initial number can be generous; skewed join partitions above the threshold
# are split. Scans read 256 MB splits.
CLUSTER_SQL_DEFAULTS = {
    **SQL_DEFAULTS,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
}


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL options on an existing session (e.g. ``CLUSTER_SQL_DEFAULTS``)."""
    for k, v in conf.items():
        spark.conf.set(k, v)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tradewatch") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one only in local mode, if the session has none.

    On a cluster a folder of the driver's own disk is of no use to executors, so its lack raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tradewatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "tradewatch", f"{name}-{uuid.uuid4().hex[:12]}")
