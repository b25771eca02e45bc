"""Time arithmetic on TIMESTAMP_NTZ."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayframe.functions.timeops import hour_field, hours_between, micros_between


def test_hour_field_and_epoch(spark):
    a = dt.datetime(2024, 3, 9, 12, 0, 0)
    rows = [(a, a + dt.timedelta(hours=26, minutes=30)),      # 1 day 02:30 -> field 2
            (a, a + dt.timedelta(minutes=59)),                # 00:59 -> 0
            (a, a + dt.timedelta(days=2, hours=23, seconds=1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(hour_field(F.col("a"), F.col("b")).alias("h"),
                    hours_between(F.col("a"), F.col("b")).alias("hb"),
                    micros_between(F.col("a"), F.col("b")).alias("us")).collect()
    assert [r.h for r in got] == [2, 0, 23]
    assert [r.hb for r in got] == pytest.approx([26.5, 59 / 60, 71 + 1 / 3600], rel=1e-12)
    assert got[0].us == (26 * 3600 + 30 * 60) * 1_000_000


def test_differences_ignore_session_time_zone(spark):
    """Across a DST change the NTZ difference stays wall-clock exact."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 12), dt.datetime(2024, 3, 11, 12))],
                                   "a timestamp_ntz, b timestamp_ntz")
        us = df.select(micros_between(F.col("a"), F.col("b")).alias("us")).first().us
        assert us == 48 * 3600 * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
