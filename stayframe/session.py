"""SparkSession helper: the settings every entry point shares."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipelines rely on for identical results and a sane plan.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot stay is split even where the grouping behind the join then needs a shuffle of its own
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (the library does not depend on them;
# a session built elsewhere works unchanged).  Partitions are sized by bytes so
# the same job fits 1 GB or 100 TB: AQE starts from many shuffle partitions and
# coalesces them to the advisory size, splits skewed join partitions, and
# converts joins to broadcast only when a side's measured size is small.
CLUSTER_CONF = {
    **BASE_CONF,
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # spark.checkpoint.dir: a folder shared by all executors (HDFS/S3/ABFS)
}


def get_spark(cpus: int | str = "*", shuffle_partitions: int | None = None,
              app: str = "stayframe") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the given one."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("STAYFRAME_DRIVER_MEM", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one when it is unset.

    A machine-local folder is only acceptable in local mode (tests, bench); on a
    cluster the executors must share the folder, so an unset setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.conf.get("spark.master", "") or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="stayframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local
