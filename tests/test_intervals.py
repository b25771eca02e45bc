"""Interval index against every pair of a key, and the number of candidates it looks at."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayframe.operators.episodes import overlap_days
from stayframe.operators.intervals import BIN, bin_width, in_intervals, interval_index

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


def _frames(spark, seed=3, n=300):
    rnd = random.Random(seed)

    def time(p_null=0.05):
        return None if rnd.random() < p_null else T0 + rnd.randint(-30, 200) * H

    points = [(rnd.choice([None, 1, 1, 1, 2, 3]), time(), i) for i in range(n)]
    intervals = []
    for j in range(60):
        s = time()
        e = rnd.choice([None, s, s and s + rnd.randint(-3, 90) * H, s and s + rnd.randint(0, 3) * H])
        intervals.append((rnd.choice([None, 1, 1, 2, 4]), s, e, j))
    return points, intervals


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("open_start,open_end", [(False, False), (False, True), (True, True)])
@pytest.mark.parametrize("width", [None, 0.5, 1000])
def test_matches_are_those_of_all_pairs(spark, how, open_start, open_end, width):
    points, intervals = _frames(spark)
    p = spark.createDataFrame(points, "stay long, charttime timestamp_ntz, rid long")
    i = spark.createDataFrame(intervals, "stay long, starttime timestamp_ntz, endtime timestamp_ntz, iid long")
    got = in_intervals(p, i, ["stay"], how=how, cols=("iid",), width_hours=width, open_start=open_start, open_end=open_end)
    want = []
    for stay, t, rid in points:
        hits = [iid for s2, s, e, iid in intervals
                if stay is not None and stay == s2 and t is not None
                and ((s is None and open_start) or (s is not None and s <= t))
                and ((e is None and open_end) or (e is not None and t <= e))]
        want += [(rid, True, iid) for iid in hits] or ([(rid, False, None)] if how == "left" else [])
    assert sorted(got.select("rid", "matched", "iid").collect(), key=str) == sorted(want, key=str)


def test_long_stay_looks_at_few_candidates(spark):
    """One stay with 400 episodes one after another and 20 000 points: candidates at most twice the matches."""
    rnd = random.Random(5)
    at, rows = T0, []
    for k in range(400):
        length = dt.timedelta(minutes=rnd.choice([20, 60, 300, 3000]))
        rows.append((1, at, at + length, k))
        at += length + dt.timedelta(minutes=30)
    minutes = int((at - T0).total_seconds() / 60)
    points = spark.range(20_000).select(
        F.lit(1).cast("long").alias("stay"), F.col("id").alias("rid"),
        F.timestamp_add("MINUTE", F.pmod(F.xxhash64("id"), F.lit(minutes)).cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("charttime"))
    intervals = spark.createDataFrame(rows, "stay long, starttime timestamp_ntz, endtime timestamp_ntz, iid long")
    width = bin_width(intervals, "starttime", "endtime")
    index = interval_index(intervals, "starttime", "endtime", width)
    assert index.count() <= 6 * 400
    matches = in_intervals(points, intervals, ["stay"], how="inner").count()
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    binned = points.withColumn(BIN, F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col("charttime")) / width))
    candidates = binned.join(index, ["stay", BIN]).count()
    assert matches > 15_000 and candidates <= 2 * matches
    assert candidates < 0.02 * 20_000 * 400  # pairs of the stay


def test_days_of_an_episode_are_those_of_its_definition(spark):
    """Starts and ends on, and one microsecond beside, the borders of days; NULL ends; days made, not filtered."""
    edges = [dt.timedelta(hours=24 * d) + dt.timedelta(microseconds=u) for d in range(-2, 9) for u in (-1, 0, 1)]
    rows = [(i, T0, T0 + s, None if e is None else T0 + e)
            for i, (s, e) in enumerate((s, e) for s in edges for e in [*edges, None] if e is None or e >= s)]
    df = spark.createDataFrame(rows, "icustay_id long, admittime timestamp_ntz, starttime timestamp_ntz, endtime timestamp_ntz")
    made = overlap_days(df)
    assert "Filter" not in made._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    want = set()
    for i, _, start, end in rows:
        for d in range(1, 8):
            lo, hi = T0 + dt.timedelta(days=d - 1), T0 + dt.timedelta(days=d)
            if lo < start <= hi or (start <= lo and end is not None and end > lo):
                want.add((i, d))
    got = [(r.icustay_id, r.day) for r in made.collect()]
    assert len(got) == len(set(got)) and set(got) == want
