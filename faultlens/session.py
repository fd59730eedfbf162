"""Session settings the operators rely on, and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """All times are UTC; adaptive execution splits skewed join partitions; Python tasks get small batches of long rows."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a fresh temporary folder; on a cluster that would not survive
    the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="faultlens-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one for one run's tables."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several branches read, and read it back.

    The table lies in the shared folder, so losing an executor costs nothing, and
    each branch scans only the columns it needs.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def python_tasks(spark: SparkSession) -> int:
    """Partition count for CPU-heavy grouped Python work."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, 2 * spark.sparkContext.defaultParallelism)
