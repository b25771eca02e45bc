"""Gap-and-terminator sessions (X4) and episode/day overlap flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.functions.timeops import hours_between, micros_between, US_PER_DAY, US_PER_HOUR
from stayframe.operators.sequence import RANGE, running_sum, scan


def episode_rows(flags: DataFrame, on: str = "mechvent", off: str = "extubated",
                 max_gap_hours: float = 8.0, key: str = "icustay_id",
                 time_col: str = "charttime", tiebreak: tuple[str, ...] = (),
                 keep=None) -> DataFrame:
    """Number the 'on' rows of each stay into episodes (rows kept).

    A row starts a new episode when it is 'on' and (a) the previous row of the
    stay was an 'off' terminator, or (b) the previous 'on' row is more than
    ``max_gap_hours`` back (strict), or (c) there is no previous 'on' row.  An
    'off' row never starts one.  The episode number is a running sum over the
    stay ordered by time with peers included (RANGE frame), kept on 'on' rows.

    Both look-ups are prefix scans over the same stored ranges of (stay, time)
    (``operators.sequence``), so a very long stay is spread over many tasks
    instead of one: one scan for the previous/next rows and the previous 'on'
    row, one for the running sum.  ``keep(name)`` may give the callables that
    store the ranges and, between the scans, the flagged rows.
    """
    rows = flags.where((F.col(on) == 1) | (F.col(off) == 1))
    t = F.col(time_col)
    order = [time_col, *tiebreak]
    # previous / next row of the stay, and the previous 'on' row (a lag within
    # the stay's 'on' rows), in one scan
    nb = scan(rows, [key], order, [time_col, off], prev=1, nxt=1, carry={"_prevon": F.col(on) == 1},
              carry_cols=[time_col], keep=keep and keep("ranges"))
    prev_on_time = F.col(f"_prevon_{time_col}")
    gap_us = micros_between(prev_on_time, t)
    is_on = F.col(on) == 1
    newvent = (
        F.when(F.col(off) == 1, 0)
        .when(is_on & (F.col(f"prev1_{off}") == 1), 1)
        .when(is_on & (gap_us > int(max_gap_hours * US_PER_HOUR)), 1)
        .when(is_on & prev_on_time.isNull(), 1)
        .otherwise(0)
    )
    staged = nb.select(
        RANGE, key, time_col, on, off,
        F.col(f"next1_{time_col}").alias("leadtime"),
        newvent.alias("newvent"),
    )
    flagged = keep and keep("flagged")
    if flagged:
        staged = flagged(staged)
    # running sum over the stay by time with peers included (RANGE frame)
    summed = running_sum(staged, [key], time_col, "newvent", "_vsum")
    return summed.withColumn("ventnum", F.when(F.col(on) == 1, F.col("_vsum"))).drop("_vsum", RANGE)


def episodes(flags: DataFrame, on: str = "mechvent", off: str = "extubated",
             max_gap_hours: float = 8.0, key: str = "icustay_id",
             time_col: str = "charttime", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Summarise numbered episodes: start, end and duration in hours.

    The end of a single-time episode is the next row's time of the stay
    (possibly NULL), and so is its duration.
    """
    return summarise_episodes(
        episode_rows(flags, on, off, max_gap_hours, key, time_col, tiebreak), key, time_col)


def summarise_episodes(numbered: DataFrame, key: str = "icustay_id",
                       time_col: str = "charttime") -> DataFrame:
    """Start, end and duration per numbered episode (rows of ``episode_rows``)."""
    g = numbered.where(F.col("ventnum") >= 1).groupBy(key, "ventnum").agg(
        F.min(time_col).alias("starttime"),
        F.max(time_col).alias("_maxt"),
        F.max("leadtime").alias("_maxlead"),
    )
    zero = hours_between(F.col("starttime"), F.col("_maxt")) == 0
    return g.select(
        key, "ventnum", "starttime",
        F.when(zero, F.col("_maxlead")).otherwise(F.col("_maxt")).alias("endtime"),
        F.when(zero, hours_between(F.col("starttime"), F.col("_maxlead")))
        .otherwise(hours_between(F.col("starttime"), F.col("_maxt")))
        .alias("duration_hours"),
    )


def overlap_days(episodes_df: DataFrame, origin: str = "admittime", n_days: int = 7,
                 key: str = "icustay_id") -> DataFrame:
    """Rows (day, episode) for every day 1..n an episode touches.

    Day d spans ((d-1)*24, d*24] hours after ``origin``.  An episode touches d
    when it starts inside the day, or starts at/before the day and ends after
    its start.  So it touches the day its start falls in and all days up to the
    one its end falls in; only those are made.  An episode without an end touches
    the day it starts in, and no day if that is before the first.
    """
    starts, ends = (_day_of(micros_between(F.col(origin), F.col(c))) for c in ("starttime", "endtime"))
    first = F.greatest(F.lit(1), starts)
    last = F.when(starts >= 1, F.greatest(starts, ends)).otherwise(ends)
    days = F.when((first <= last) & (first <= n_days), F.sequence(first, F.least(F.lit(n_days), last)))
    return episodes_df.withColumn("day", F.explode(days))


def _day_of(offset_us):
    """The day d with (d-1) * 24 h < offset <= d * 24 h."""
    return (-F.floor(-offset_us / US_PER_DAY)).cast("int")
