"""Hand-made edge frames for the composite operators (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from stayframe.operators.episodes import episodes, overlap_days
from stayframe.operators.twm import twm_value, with_nearest_neighbour_diff
from stayframe.operators.windows import asof_last
from stayframe.plans.cohort import not_in
from stayframe.functions.rules import rule_column
from stayframe.plans.score_rules import KDIGO

T0 = dt.datetime(2024, 1, 1)


def t(hours=0, seconds=0):
    return T0 + dt.timedelta(hours=hours, seconds=seconds)


def test_episodes_gap_and_terminator(spark):
    rows = [  # (stay, time, on, off)
        (1, t(0), 1, 0), (1, t(8), 1, 0),            # exactly 8 h: same episode
        (1, t(16, 1), 1, 0),                          # 8 h + 1 s: new episode
        (1, t(17), 0, 1), (1, t(18), 1, 0),           # off then on: new episode
        (1, t(19), 1, 1),                             # both flags: not a start
        (2, t(5), 1, 0),                              # single on at the end: NULL end
    ]
    df = spark.createDataFrame(rows, "icustay_id long, charttime timestamp_ntz, "
                                     "mechvent int, extubated int")
    got = sorted((r.icustay_id, r.ventnum, r.starttime, r.endtime)
                 for r in episodes(df).collect())
    # episode 2 is a single time, so its end is the next row's time (the off row)
    assert got == [(1, 1, t(0), t(8)), (1, 2, t(16, 1), t(17)),
                   (1, 3, t(18), t(19)), (2, 1, t(5), None)]


def test_overlap_days(spark):
    adm = t(0)
    rows = [(1, adm, t(2), t(3)),        # inside day 1
            (2, adm, t(23), t(25)),      # across midnight of day 1/2
            (3, adm, t(24), t(90)),      # starts exactly at 24 h: day 1..4
            (4, adm, t(30), None)]       # NULL end: only its start day
    df = spark.createDataFrame(rows, "icustay_id long, admittime timestamp_ntz, "
                                     "starttime timestamp_ntz, endtime timestamp_ntz")
    got = sorted((r.icustay_id, r.day) for r in overlap_days(df).collect())
    assert got == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (3, 4), (4, 2)]


def test_asof_last_lookback(spark):
    left = spark.createDataFrame([(1, t(10)), (2, t(10)), (3, t(10)), (4, t(10)), (5, t(10))],
                                 "icustay_id long, charttime timestamp_ntz")
    right = spark.createDataFrame([
        (1, t(8), 90.0),                   # exactly 2 h before: kept
        (2, t(8, -1), 91.0),               # 2 h + 1 s before: too old
        (3, t(10), 92.0), (3, t(9), 93.0),  # same time wins over older
        (4, t(10, 1), 94.0),               # after: ignored
        (5, t(9), None), (5, t(8, 30), 95.0),  # latest row wins even with NULL value
    ], "icustay_id long, charttime timestamp_ntz, spo2 double")
    got = {r.icustay_id: r.spo2 for r in asof_last(left, right, "icustay_id", 2, ["spo2"])
           .collect()}
    assert got == {1: 90.0, 2: None, 3: 92.0, 4: None, 5: None}


def test_asof_last_across_time_buckets(spark):
    # 2 h lookback -> 8 h buckets starting at midnight; left rows at 16:00 sit at
    # the start of a bucket and must still see right rows of the bucket before
    left = spark.createDataFrame([(1, t(16)), (2, t(16)), (3, t(17))],
                                 "icustay_id long, charttime timestamp_ntz")
    right = spark.createDataFrame([(1, t(14), 1.0), (2, t(14, -1), 2.0), (3, t(15, 30), 3.0)],
                                  "icustay_id long, charttime timestamp_ntz, spo2 double")
    got = {r.icustay_id: r.spo2 for r in asof_last(left, right, "icustay_id", 2, ["spo2"])
           .collect()}
    assert got == {1: 1.0, 2: None, 3: 3.0}


def test_nearest_neighbour_branches(spark):
    rows = [  # stay, t(h), mabp, cvp
        (1, 0.0, 80.0, None), (1, 1.0, None, 10.0), (1, 3.0, 70.0, None),   # prev nearer
        (2, 0.0, 80.0, None), (2, 2.0, None, 10.0), (2, 3.0, 70.0, None),   # next nearer
        (3, 0.0, 80.0, None), (3, 1.0, None, 10.0), (3, 2.0, 70.0, None),   # equal -> next
        (4, 0.0, None, 5.0), (4, 1.0, 60.0, None),                          # first row
        (5, 0.0, 70.0, None), (5, 1.0, None, 8.0), (5, 1.5, None, 9.0),     # two cvp
        (5, 10.0, 50.0, None), (5, 11.0, 40.0, None),
        (6, 0.0, 70.0, None), (6, 0.5, 65.0, None), (6, 5.0, None, 7.0),    # two cvp, the
        (6, 5.5, None, 6.0), (6, 6.0, 55.0, None),                          # next pair nearer
    ]
    df = spark.createDataFrame(
        [(s, T0 + dt.timedelta(hours=h), m, c, i) for i, (s, h, m, c) in enumerate(rows)],
        "icustay_id long, charttime timestamp_ntz, mabp double, cvp double, row_id long")
    out = with_nearest_neighbour_diff(df, "icustay_id", ["charttime", "row_id"], "cvp", "mabp",
                                      "mpp")
    got = {(r.icustay_id, r.cvp): r.mpp for r in out.where(F.col("cvp").isNotNull()).collect()}
    assert got[(1, 10.0)] == 70.0
    assert got[(2, 10.0)] == 60.0
    assert got[(3, 10.0)] == 60.0
    assert got[(4, 5.0)] is None          # first row: compares with NULL, falls through
    assert got[(5, 8.0)] is None          # next row nearer but has no MAP; no 2-step arm fits
    assert got[(5, 9.0)] == 61.0          # prev row has no MAP: two back (70) is nearer
    assert got[(6, 7.0)] == 48.0          # next row has no MAP: two ahead (55) is nearer


def test_twm_value_null_vs_zero(spark):
    df = spark.createDataFrame([(0.0, 5.0, 7.0), (None, None, 7.0), (2.0, 0.0, 7.0),
                                (2.0, 10.0, 7.0)], "sw double, svw double, mx double")
    got = [r.v for r in df.select(twm_value(F.col("sw"), F.col("svw"), F.col("mx")).alias("v"))
           .collect()]
    assert got == [7.0, None, 7.0, 5.0]


def test_kdigo_traps(spark):
    rows = [  # creat, mdrd baseline, u6, u12, u24, rrt
        (19.5, 10.0, None, None, None, None),   # ratio 1.95: between the ratio bands
        (29.5, 10.0, None, None, None, None),   # ratio 2.95: likewise
        (70.0, 20.0, None, None, None, None),   # ratio 3.5 with diff >= 26.5: stage 1 first
        (10.0, 10.0, None, 0.0, None, None),    # u12 = 0 -> 3
        (10.0, 10.0, None, None, None, 1),      # rrt only -> 3
        (None, None, None, None, None, None),   # all NULL -> no stage
        (10.0, 10.0, 0.4, 0.6, 2.0, None),      # stage 1 needs u24 >= 3 -> none
    ]
    df = spark.createDataFrame(rows, "creat_max double, mdrd_creat75 double, "
                                     "urine_6h_kgh double, urine_12h_kgh double, "
                                     "urine_24h_kgh double, rrt int")
    got = [x.k for x in df.select(rule_column(*KDIGO).alias("k")).collect()]
    assert got == [None, None, 1, 3, 3, None, None]


def test_not_in_null_semantics(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    ex_plain = spark.createDataFrame([(2,)], "k long")
    ex_null = spark.createDataFrame([(2,), (None,)], "k long")
    ex_empty = spark.createDataFrame([], "k long")
    assert sorted(r.k for r in not_in(df, ex_plain, "k").collect()) == [1]
    assert not_in(df, ex_null, "k").count() == 0
    assert sorted((r.k is None, r.k) for r in not_in(df, ex_empty, "k").collect()) == \
        [(False, 1), (False, 2), (True, None)]
