"""Spark session with the settings the operators are written for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  AQE re-plans joins at runtime
# (a shuffle side that turns out small becomes a broadcast, skewed partitions
# are split), so no operator hard-codes a broadcast of a derived table.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
    # delete checkpoint files once their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "kpiloom", driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(shuffle_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a cluster run.

    ``shuffle_bytes`` is the largest exchange expected after partial
    aggregation (for the KPI jobs one row per order or customer, a few percent
    of the fact table), not the input size: with M map and R reduce tasks a
    shuffle has M x R blocks that the driver tracks.

    * scans: splits of up to 1 GB keep the number of map tasks down;
    * shuffles: AQE starts from enough partitions for the target size, at
      least three waves of the cluster's cores and at most 20,000, and
      coalesces small ones at runtime;
    * skew: a partition over 4x the median and the target size is split.
    """
    cores = max(1, executor_cores * executors)
    initial = min(20_000, max(3 * cores, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(1 << 30),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (cluster-wide, shared storage) wins.  Where it is
    unset, a one-machine session (tests) registers ``fallback`` or a folder of
    its own; a cluster session has no folder that all executors see, so that
    is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") and fallback is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                           "(a machine-local folder does not survive a lost executor)")
    path = fallback or tempfile.mkdtemp(prefix="kpiloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint location for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir() is ``<dir>/<uuid>``: keep tables beside the RDD data.
    return f"{base}/tables/{name}"
