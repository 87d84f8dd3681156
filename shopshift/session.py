"""Session helpers: building a local session and locating the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "shopshift") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC, ANSI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is read from the session and never
    invented.  Only a local-mode session without one (tests, a laptop) gets
    a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at shared storage so that "
            "materialised stages survive executor loss"
        )
    scratch = tempfile.mkdtemp(prefix="shopshift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()
