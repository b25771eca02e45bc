"""Medians by selection against the aggregate, and how a hot group is spread."""

import random

from pyspark.sql import functions as F

from stayframe.operators.selection import medians
from stayframe.operators.sequence import RANGE
from stayframe.sources.staging import new_run_id, stage


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equal_to_the_aggregate(spark):
    rng = random.Random(5)
    values = [None, 0.1, 0.2, 0.3, -4.0, 1e300, 7.5]
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice("ab"), rng.choice(values) if rng.random() < .5 else rng.gauss(0, 1))
            for _ in range(700)] + [(9, "a", None), (10, "a", 1.0), (11, "b", 1.0), (11, "b", 2.0)]
    df = spark.createDataFrame(rows, "k long, s string, v double").repartition(5)
    want = df.groupBy("k", "s").agg(F.median("v").alias("median")).where("median IS NOT NULL")
    assert _rows(medians(df, ["k", "s"], "v")) == _rows(want)
    assert _rows(medians(df, ["s"], "v")) == _rows(df.groupBy("s").agg(F.median("v")))
    assert medians(df.limit(0), ["k"], "v").count() == 0


def test_hot_group_is_spread(spark):
    """A third of all rows in one group, all values different."""
    kept = []

    def keep(df):
        kept.append(stage(spark, df, "hot", new_run_id()))
        return kept[-1]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("k"),
            (F.xxhash64("id") / 1e9).alias("v"))
        assert _rows(medians(df, ["k"], "v", keep=keep)) == _rows(df.groupBy("k").agg(F.median("v")))
        sizes = [r["count"] for r in kept[0].groupBy(RANGE).count().collect()]
        assert len(sizes) >= 9 and max(sizes) < 3 * 30_000 / 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
