"""Session set-up for tests and benchmarks, and the shared scratch folder for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int | None = None) -> SparkSession:
    """A single-machine session; clusters bring their own session and settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyforge")
        .config("spark.sql.shuffle.partitions", str(partitions or (8 if cores == "*" else cores)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tallyforge-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused between calls."""
    return os.path.join(checkpoint_root(spark), "tallyforge", f"{name}-{uuid.uuid4().hex[:12]}")
