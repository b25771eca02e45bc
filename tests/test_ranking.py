"""Ranks over ranges against plain windows, and how a hot key is spread."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayframe.operators.ranking import ranks
from stayframe.operators.sequence import RANGE
from stayframe.sources.staging import new_run_id, stage

WANTED = {"dense": (["k"], ["v"]), "row": (["k"], None), "sub_row": (["k", "v"], None), "sub_dense": (["k", "v"], ["w"])}


def _order():
    return ["k", F.col("v").desc_nulls_first(), "w", "id"]


def _plain(df):
    by_v = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first())
    return df.select("*", F.dense_rank().over(by_v).alias("dense"),
                     F.row_number().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_first(), "w", "id")).alias("row"),
                     F.row_number().over(Window.partitionBy("k", "v").orderBy("w", "id")).alias("sub_row"),
                     F.dense_rank().over(Window.partitionBy("k", "v").orderBy("w")).alias("sub_dense"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _table(spark, n, keys, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.choice([None, 1.0, 2.0, 2.5, -1.0, 7.0]), rng.choice([None, 1, 2, 3]), i) for i in range(n)]
    return spark.createDataFrame(rows, "k long, v double, w int, id long").repartition(3)


def test_equal_to_windows(spark):
    for n, keys in ((300, [None, 1, 2, 3]), (200, [5]), (40, list(range(60))), (1, [1]), (0, [1])):
        for parts in ("1", "7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            try:
                df = _table(spark, n, keys, n)
                assert _rows(ranks(df, _order(), WANTED)) == _rows(_plain(df)), (n, parts)
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", "4")
                spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_key_and_hot_value_are_spread(spark):
    """One key holds half of all rows, nearly all with one value: no range holds much more than its share."""
    kept = []

    def keep(df):
        kept.append(stage(spark, df, "hot", new_run_id()))
        return kept[-1]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40_000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 900).alias("k"),
            F.when(F.col("id") % 50 != 0, 1.0).otherwise((F.col("id") % 13).cast("double")).alias("v"),
            (F.col("id") % 3).cast("int").alias("w"), "id")
        assert _rows(ranks(df, _order(), WANTED, keep)) == _rows(_plain(df))
        sizes = [r["count"] for r in kept[0].groupBy(RANGE).count().collect()]
        assert len(sizes) >= 12 and max(sizes) < 3 * 40_000 / 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_records_go_to_the_rows(spark):
    """The rows stay in their ranges: by size estimates Spark would send them to the records, all in one task."""
    from stayframe.operators.sequence import scan
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    run = new_run_id()
    df = stage(spark, _table(spark, 300, [1, 2, 3], 5), "t", run)
    for i, out in enumerate((ranks(df, _order(), WANTED), scan(df, ["k"], ["id"], ["v"], prev=1, nxt=1))):
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "BuildRight" in plan and "BuildLeft" not in plan, i
