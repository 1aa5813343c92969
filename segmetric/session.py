"""Session helpers: one place for the Spark settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "segmetric", cpus: str | int | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with AQE, UTC time and the UI off.

    On a cluster the session already exists (spark-submit); it is returned as it is.
    """
    active = SparkSession.getActiveSession()
    if active is not None:  # a session made elsewhere keeps its settings
        ensure_checkpoint_dir(active)
        return active
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or int(os.environ.get("SEGMETRIC_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    (local runs and tests) a private scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="segmetric-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
