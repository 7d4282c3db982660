"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ORDERED_PARTS = "spark.rollbook.orderedParts"


def local_session(cores: str | int = "*", app: str = "rollbook", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. Clusters bring their own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def split_skewed_joins(spark: SparkSession) -> None:
    """AQE leaves a skewed partition whole where splitting it adds a shuffle, unless told otherwise. The joins of hot
    keys rely on the split, so a session in which it is unset gets it; a session that sets it keeps its choice."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, "true")


def int_setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own; on a cluster
    a machine-local folder would lose data with its executor, so that raises instead.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="rollbook-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, for one table of one run."""
    return f"{shared_folder(spark).rstrip('/')}/rollbook-scratch/{label}-{uuid.uuid4().hex}"
