"""Session helpers: a local session for tests and benches, and the shared
scratch/checkpoint location that cluster jobs must use."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "feedspark", extra: dict[str, str] | None = None
) -> SparkSession:
    """Session for tests and benches (local mode, UI off, UTC, AQE on)."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # checkpoint files of ids are removed once nothing refers to them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("FEEDSPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session without one gets a fresh folder of its
    own; on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS, S3, ...) for this cluster")
        configured = tempfile.mkdtemp(prefix="feedspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint location (never reused)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/feedspark-scratch/{uuid.uuid4().hex}/{name}"
