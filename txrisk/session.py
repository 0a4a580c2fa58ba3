"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings that change results or table layout; safe to set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows take many times their shuffled size in a task that sorts them for windows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # Lets AQE hash-join instead of sort when the measured partitions are small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator here relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", app: str = "txrisk", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, build your own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Small data still spreads over all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the warehouse."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    return configured or spark.conf.get("spark.sql.warehouse.dir")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative learners a checkpoint folder so that they can cut lineage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a path of any file system Spark reads; none where it does not exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where it does not exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
