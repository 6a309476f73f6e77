"""Spark session defaults and shared scratch locations.

Scratch data (test fixture files, staged tables, stream checkpoints) lives
under the folder the cluster names in ``spark.checkpoint.dir``.  That setting
is read from the session; a local default is only installed when it is unset
(tests, single-machine runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for the 100 TB target; local runs override partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Dimensions (stores, categories, group names) stay far below this; facts never do.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Fall back from whole-stage codegen when a generated method is too large
    # for the JIT (HotSpot skips methods over 8000 bytecodes): the wide
    # canonical projections would otherwise run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlight") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor; give it the heap.
        builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLIGHT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


# Runtime SQL settings the plans are tuned for; applied to a session created
# elsewhere (e.g. by a job runner) without touching static settings.
RUNTIME_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings and make sure a checkpoint folder exists."""
    for key, value in RUNTIME_SQL_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. Where it is unset, a
    fresh local folder serves local mode and tests; on a cluster that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ledgerlight-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint directory."""
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
