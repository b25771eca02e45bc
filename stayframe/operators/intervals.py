"""Points matched with the intervals that contain them (J14), through a time-bin index.

An equi join on the stay alone pairs every point with every interval of the
stay and filters afterwards.  Here time is cut into bins: an interval is listed
under each (key, bin) it touches, a point looks under its own bin only, and the
bounds decide as a residual.  A point is in one bin and an interval is listed
once a bin, so every match is found exactly once and fan-out is kept.  A long
stay is spread over its bins.

The width is a quarter of the intervals' mean length.  Whatever the lengths,
the index then has at most six rows an interval (4 n widths in all, and a
border at each end), and under evenly spread points at most half as many
candidates fail the bounds as pass them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.functions.timeops import US_PER_HOUR, US_PER_SECOND, micros_between

BIN = "_bin"


def _micros(time: Column) -> Column:
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time)


def bin_width(intervals: DataFrame, start: str, end: str) -> int:
    """A quarter of the mean length in microseconds, one second at least; open and inverted intervals do not count."""
    length = micros_between(F.col(start), F.col(end))
    mean = intervals.where(length >= 0).agg(F.avg(length)).first()[0]
    return max(US_PER_SECOND, int((mean or 0) / 4))


def interval_index(intervals: DataFrame, start: str, end: str, width_us: int) -> DataFrame:
    """The intervals once for each bin they touch; one with a NULL or inverted bound touches none."""
    first, last = (F.floor(_micros(F.col(c)) / width_us) for c in (start, end))
    return intervals.where(F.col(start) <= F.col(end)).withColumn(BIN, F.explode(F.sequence(first, last)))


def in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], time_col: str = "charttime",
                 start: str = "starttime", end: str = "endtime", how: str = "left", cols: tuple[str, ...] = (),
                 matched: str = "matched", width_hours: float | None = None, open_start: bool = False,
                 open_end: bool = False) -> DataFrame:
    """Each point with each interval of its keys that contains it (bounds included): the points' columns,
    ``matched`` (boolean) and the intervals' ``cols``.

    ``how`` 'left' keeps a point without interval once, 'inner' drops it.  A NULL bound contains
    nothing, as in SQL, unless ``open_start`` / ``open_end`` say that it is unbounded: such an
    interval then reaches to the first / last point of its keys, which is all it can meet.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    side = intervals.select(*keys, start, end, *[c for c in cols if c not in (*keys, start, end)])
    if open_start or open_end:
        # unbounded ends, and only they, need to know how far the points of their keys reach
        reach = points.groupBy(*keys).agg(F.min(time_col).alias("_from"), F.max(time_col).alias("_to"))
        open_ = F.lit(False)
        if open_start:
            open_ = open_ | F.col(start).isNull()
        if open_end:
            open_ = open_ | F.col(end).isNull()
        bounded = side.where(~open_).withColumns({"_s": F.col(start), "_e": F.col(end)})
        unbounded = side.where(open_).join(reach, keys).withColumns({
            "_s": F.coalesce(start, F.when(F.lit(open_start), F.least("_from", F.col(end)))),
            "_e": F.coalesce(end, F.when(F.lit(open_end), F.greatest("_to", F.col(start))))}).drop("_from", "_to")
        side = bounded.unionByName(unbounded)
    else:
        side = side.withColumns({"_s": F.col(start), "_e": F.col(end)})
    width = int(width_hours * US_PER_HOUR) if width_hours else bin_width(side, "_s", "_e")
    index = interval_index(side, "_s", "_e", width).alias("i")
    p = points.withColumn(BIN, F.floor(_micros(F.col(time_col)) / width)).alias("p")
    same = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in (*keys, BIN)]
    inside = (F.col(f"p.{time_col}") >= F.col("i._s")) & (F.col(f"p.{time_col}") <= F.col("i._e"))
    # the index has more rows than the size estimate of its intervals tells: it is never sent through the driver
    joined = p.join(index.hint("merge"), reduce(Column.__and__, [*same, inside]), how)
    return joined.select(*[F.col(f"p.{c}") for c in points.columns], F.col(f"i.{BIN}").isNotNull().alias(matched),
                         *[F.col(f"i.{c}") for c in cols])
