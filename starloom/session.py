"""Session factory and shared-folder helpers.

The cluster names its shared folder in ``spark.checkpoint.dir``; every
intermediate this library writes (scratch fixtures, upsert versions,
lineage cuts) goes below it.  A folder of our own is chosen only when the
setting is absent, as in unit tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (keys are built from local
# date/time text), ANSI on, adaptive execution with skew splitting and
# runtime broadcast conversion (a size-checked broadcast with a sort-merge
# fallback), dynamic partition overwrite for loads.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Sizing defaults, applied only where the cluster has not set its own:
# broadcast only sides measured under 32 MB; shuffle partitions are
# coalesced by AQE towards 128 MB, and a partition is split as skewed above
# 5x the median and 256 MB; scans split files at 256 MB.
SIZING_DEFAULTS = {
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def get_session(master: str | None = None, app_name: str = "starloom",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    cluster = spark.sparkContext.getConf()
    for k, v in SIZING_DEFAULTS.items():
        if not cluster.contains(k) and k not in (extra or {}):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings results depend on (UTC wall clock, ANSI) on a
    session created elsewhere, e.g. by a driver; sizing is left alone."""
    for k, v in BASE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local mode only (tests): the machine is the whole cluster
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Root below which scratch tables are written (the configured
    ``spark.checkpoint.dir``, not the per-application subfolder)."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return os.path.dirname(ensure_checkpoint_dir(spark).rstrip("/"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    return f"{shared_root(spark)}/starloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut the lineage by writing a Parquet table into the shared folder
    and reading it back.  Unlike an RDD checkpoint the plan runs once, and
    the files survive the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
