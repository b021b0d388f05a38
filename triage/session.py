"""Session construction and shared-folder helpers.

Cluster jobs get their session from the platform; ``get_spark`` is for tests, the bench and
local runs. ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and only sets
a local one when the session has none (tests).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MB input splits: at 100 TB this is ~800k tasks, each comfortably in memory
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # lineage-cut data in the shared folder is removed once its DataFrame is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "triage", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if not SparkConf().contains("spark.master"):  # spark-submit names the cluster, its sizes and memory
        cpus = cpus or os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(f"local[{cpus}]")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
        conf["spark.driver.memory"] = os.environ.get("TRIAGE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and versioned outputs.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. Where it is unset, a local session
    (tests, bench) gets a fresh temporary folder; a cluster, whose machines share none, an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        sc = None
    d = d or (sc.getCheckpointDir() if sc else None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="triage-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")
