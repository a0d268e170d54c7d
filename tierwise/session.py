"""Session construction and the shared working folder.

Jobs never write to a machine-local temporary folder: scratch output goes below
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting
is absent (unit tests, a laptop) is a local folder created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


# Settings for a large cluster (hundreds of executors, ~100 TB inputs).  The
# shuffle starts wide and AQE coalesces it to the advisory size, so one setting
# fits both the 60-day cycle and a full rebuild; skewed join and rebalance
# partitions are split; broadcasts stay behind a bounded threshold; lost
# executors and fetch failures are retried.  The shared checkpoint folder is
# the cluster's (``spark.checkpoint.dir``) and is never overridden here.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.shuffle.io.maxRetries": "10",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(master: str | None = "local[8]", app: str = "tierwise",
                shuffle_partitions: int | None = 8, extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    """Session with the library's defaults; ``profile="cluster"`` adds
    :data:`CLUSTER_CONF` (``master=None`` leaves the master to spark-submit)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
        shuffle_partitions = None
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder (``spark.checkpoint.dir``).  Only a local master may
    go without: it gets a folder of its own; a cluster must name one."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tierwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the shared folder."""
    return f"{shared_dir(spark)}/tierwise/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`scratch_path` named."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
