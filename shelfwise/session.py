"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Fewer, larger tasks and files than the default over terabytes of raw text.
    "spark.sql.files.maxPartitionBytes": "256m",
    # A partitioned write keeps its few files open at once instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Bronze is written shredded and read field by field.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}

_fallback_root: tempfile.TemporaryDirectory | None = None


def tune(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the recommended runtime settings to a session and return it.

    On a cluster give ``shuffle_partitions`` as a few times the number of cores:
    Spark merges small shuffle partitions up to its advisory size but does not
    split large even ones, so it has to start from enough of them.
    """
    settings = dict(RUNTIME_SETTINGS)
    if shuffle_partitions is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = shuffle_partitions
        settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the cluster's shared checkpoint folder.

    A local session without that setting gets a temporary folder that goes when Python
    ends; a cluster without it is an error, since executors could not see a
    driver-local path. What is below the named folder is its owner's to remove.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _local_root(spark)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _local_root(spark: SparkSession) -> str:
    global _fallback_root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _fallback_root is None:
        _fallback_root = tempfile.TemporaryDirectory(prefix="shelfwise-")
    return _fallback_root.name
