"""Prefix scans over ranges agree with plain per-stay windows (property tests), whatever the ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayframe.operators.sequence import RANGE, group_start, last_before, neighbours, ranged, running_sum, scan


@pytest.fixture(autouse=True, params=[1, 13, 60])
def ranges(spark, request):
    """So many ranges: from one to ranges of a few rows each, so that one stay runs over most of them."""
    conf = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _frame(spark, seed=7, n=600):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        stay = rnd.choice([1, 1, 1, 1, 2, 3])           # stay 1 is "hot"
        t = t0 + dt.timedelta(minutes=rnd.randint(0, 240), seconds=rnd.choice([0, 0, 30]))
        v = rnd.choice([None, float(rnd.randint(0, 9))])
        rows.append((stay, t, i, v, rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "stay long, t timestamp_ntz, rid long, v double, f int")


def test_neighbours_match_lag_lead(spark):
    df = _frame(spark)
    w = Window.partitionBy("stay").orderBy("t", "rid")
    want = {r.rid: (r.a, r.b, r.c, r.d) for r in df.select(
        "rid", F.lag("v").over(w).alias("a"), F.lag("v", 2).over(w).alias("b"),
        F.lead("v").over(w).alias("c"), F.lead("v", 2).over(w).alias("d")).collect()}
    got_df = neighbours(df, ["stay"], ["t", "rid"], ["v", "rid"], prev=2, nxt=2)
    got = {r.rid: (r.prev1_v, r.prev2_v, r.next1_v, r.next2_v) for r in got_df.collect()}
    assert got == want
    # positions too (values alone could hide a wrong row with the same value)
    want_rid = {r.rid: (r.a, r.b) for r in df.select(
        "rid", F.lag("rid").over(w).alias("a"), F.lead("rid", 2).over(w).alias("b")).collect()}
    got_rid = {r.rid: (r.prev1_rid, r.next2_rid) for r in got_df.collect()}
    assert got_rid == want_rid


def test_last_before_matches_conditional_lag(spark):
    df = _frame(spark, seed=11)
    w = Window.partitionBy("stay", "f").orderBy("t", "rid")
    want = {r.rid: r.p for r in df.select("rid", "f", F.lag("rid").over(w).alias("p")).collect()
            if r.f == 1}
    got_df = last_before(df, ["stay"], ["t", "rid"], F.col("f") == 1, ["rid"], "prevon")
    got = {r.rid: r.prevon_rid for r in got_df.collect() if r.f == 1}
    assert got == want


def test_running_sum_range_frame(spark):
    df = _frame(spark, seed=3).withColumn("x", F.col("f").cast("long"))
    w = Window.partitionBy("stay").orderBy("t")
    want = {r.rid: r.s for r in df.select("rid", F.sum("x").over(w).alias("s")).collect()}
    got = {r.rid: r.s for r in running_sum(df, ["stay"], "t", "x", "s").collect()}
    assert got == want


def test_group_start(spark):
    df = _frame(spark, seed=5)
    want = {r.rid: r.m for r in df.select(
        "rid", F.min("t").over(Window.partitionBy("stay")).alias("m")).collect()}
    got = {r.rid: r.m for r in group_start(df, ["stay"], "t", "m").collect()}
    assert got == want


def test_null_keys_nulls_and_two_keys(spark):
    """Null keys are a group; null values and sums; a second key; several ranges of one row."""
    rnd = random.Random(2)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice("ab"), t0 + dt.timedelta(minutes=rnd.randint(0, 50)), i,
             rnd.choice([None, 1, 2])) for i in range(90)]
    df = spark.createDataFrame(rows, "stay long, kind string, t timestamp_ntz, rid long, x long")
    keys, order = ["kind", "stay"], ["t", "rid"]
    w = Window.partitionBy(*keys).orderBy(*order)
    want = df.select("rid", F.lag("rid", 2).over(w).alias("p"), F.lead("rid").over(w).alias("n"),
                     F.last(F.when(F.col("x") == 1, F.col("rid")), True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("c"),
                     F.min("t").over(Window.partitionBy(*keys)).alias("s"),
                     F.sum("x").over(Window.partitionBy(*keys).orderBy("t")).alias("z")).collect()
    out = scan(df, keys, order, ["rid"], prev=2, nxt=1, carry={"one": F.col("x") == 1}, carry_cols=["rid"], start="s")
    out = scan(out, keys, ["t"], total=("z", "x"))  # goes on in the same ranges
    got = out.select("rid", "prev2_rid", "next1_rid", "one_rid", "s", "z").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_empty_table(spark):
    df = spark.createDataFrame([], "stay long, t timestamp_ntz, rid long")
    assert neighbours(df, ["stay"], ["t", "rid"], ["rid"], prev=2, nxt=2).collect() == []


def test_hot_stay_is_spread_and_records_are_few(spark, ranges):
    """A third of all rows in one stay: no range holds more than twice its share, one record a range."""
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.pmod(F.xxhash64("id"), F.lit(2000))).alias("stay"),
        F.timestamp_add("SECOND", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)).cast("int"), t0).alias("t"), F.col("id").alias("rid"))
    stored = ranged(df, ["stay"], ["t", "rid"])
    sizes = [r["n"] for r in stored.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 60_000 and len(sizes) == ranges and len(sizes) < 0.01 * 60_000
    assert max(sizes) <= 2 * 60_000 / ranges
    w = Window.partitionBy("stay").orderBy("t", "rid")
    got = neighbours(stored, ["stay"], ["t", "rid"], ["rid"], prev=1).select("rid", "prev1_rid")
    want = df.select("rid", F.lag("rid").over(w).alias("prev1_rid"))
    assert got.exceptAll(want).count() == 0 and got.count() == 60_000
