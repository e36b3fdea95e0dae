"""Session helpers.

A library must not assume it owns the session: everything here only *fills in*
settings that the cluster has not set, so a production session (with its own
shuffle sizing and a shared ``spark.checkpoint.dir``) is left alone.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for local runs and tests. On a cluster these come from the job config.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "sluice", extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with sane defaults for local runs."""
    master = master or os.environ.get("SLUICE_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SLUICE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``; we only set one of our own
    when it is unset and the master is local (tests), and then under ``/tmp``; on a
    cluster an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if current:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sluice-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for streaming checkpoints and
    lineage-cutting tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
