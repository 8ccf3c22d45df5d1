"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs rely on: UTC for date arithmetic, ANSI casts (strict
# staging raises, tolerant staging uses try_cast), AQE for runtime re-plans
# (coalescing, skew-join splits, broadcast conversion on real sizes).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


# Profile for a large cluster (~100 TB of input, ~1000 executors).  Initial
# shuffle partitions are set high and AQE coalesces them to the advisory size
# (sizes first, not parallelism); skewed join partitions above 5x the median
# and 512 MB are split; scans split at 512 MB.  Broadcasts are bounded by rows in
# memory (``lading.functions.joins``, and AQE's measured sizes); the planner's own
# bound, on file sizes, is lower, since files are many times smaller than their rows.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4000",
    "lading.broadcast.maxBytes": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lading", extra: dict | None = None,
                  cluster: bool = False) -> SparkSession:
    """Session with the jobs' defaults; ``cluster=True`` adds ``CLUSTER_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster to a shared,
    fault-tolerant folder).  Only when it is unset in local mode (tests) is a
    scratch folder created and registered; on a cluster an unset value is
    an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # a driver-local folder is invisible to the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(intermediate tables are written there)")
        configured = tempfile.mkdtemp(prefix="lading-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", name)
