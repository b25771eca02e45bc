"""Stored intermediate tables (K1/K2 sinks, S2 scans) in the shared checkpoint folder.

``stage`` writes a DataFrame as parquet under ``spark.checkpoint.dir`` (the
folder a cluster shares between executors; set only when unset, e.g. in
tests) and returns a scan of it.  Readers get column pruning and parquet
predicate pushdown, the lineage is cut (a lost executor re-reads files instead
of recomputing the chain), and plans stay small.  Event tables are sorted by
``itemid`` inside each file so row-group statistics prune item-list filters.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stayframe.session import ensure_checkpoint_dir


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def stage(spark: SparkSession, df: DataFrame, name: str, run_id: str,
          sort_within: tuple[str, ...] = ()) -> DataFrame:
    path = f"{run_folder(spark, run_id)}/{name}"
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_by_key(spark: SparkSession, df: DataFrame, name: str, run_id: str,
                 key: tuple[str, ...], buckets: int) -> DataFrame:
    """Store rows as a table bucketed and sorted by ``key``: one file a bucket.

    Two such tables of equally many buckets join on ``key`` without an exchange,
    and so do groupings on it.  A bucket is read by one task, so only tables with
    a bounded number of rows per key belong here.
    """
    table = f"{table_prefix(run_id)}{name}"
    (df.repartition(buckets, *key).write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
     .option("path", f"{run_folder(spark, run_id)}/{name}").saveAsTable(table))
    return spark.table(table)


def table_prefix(run_id: str) -> str:
    return f"stayframe_{run_id}_"


def forget_tables(spark: SparkSession, run_id: str) -> None:
    """Catalog entries of a run's bucketed tables; their files go with the run's folder."""
    for t in spark.catalog.listTables(pattern=f"{table_prefix(run_id)}*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def run_folder(spark: SparkSession, run_id: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stayframe/{run_id}"


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a stored folder with the file system it is on; False if there was none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    """Sink of a concept: ``overwrite`` as K1 ``CREATE TABLE AS`` after a drop and K2
    ``SELECT INTO`` do, or ``errorifexists`` (K6: the second run fails)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
