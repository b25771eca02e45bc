"""Time arithmetic on TIMESTAMP_NTZ columns.

All differences are taken with ``timestamp_diff(MICROSECOND, ...)``, which is
independent of the session time zone for TIMESTAMP_NTZ (``unix_micros`` of a
cast is not: it shifts across DST changes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND
US_PER_DAY = 24 * US_PER_HOUR


def micros_between(start: Column, end: Column) -> Column:
    """end - start in microseconds (BIGINT)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    """``extract(epoch from end - start)`` as DOUBLE seconds."""
    return micros_between(start, end) / F.lit(float(US_PER_SECOND))


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 60 / 60


def hour_field(start: Column, end: Column) -> Column:
    """``extract(hour from end - start)``: the 0-23 hour *field*."""
    return F.extract(F.lit("HOUR"), end - start)


def plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.make_dt_interval(F.lit(days))


# Day-bucket styles.  Bucket 1 is always "offset <= width" with no
# lower bound; bucket k >= 2 covers ((k-1)*width, k*width] minus the holes the
# style leaves at its edges.  r = offset - (k-1)*width lies in (0, width].
STYLES = ("open", "half_mixed", "closed_hi", "bili", "between", "between_day1_plus1s")


def day_bucket(delta_us: Column, width_hours: int = 24, n: int = 7,
               style: str = "between") -> Column:
    """Offset (µs) from an origin -> bucket 1..n, NULL outside or in a hole."""
    if style not in STYLES:
        raise ValueError(f"unknown day-bucket style {style!r}")
    width = width_hours * US_PER_HOUR
    one_s = US_PER_SECOND
    k = F.ceil(delta_us / F.lit(float(width))).cast("bigint")
    r = delta_us - (k - 1) * width
    if style == "open":
        ok = (r > one_s) & (r < width)
    elif style == "half_mixed":
        ok = ((k <= 5) | (r > one_s)) & (r < width)
    elif style == "closed_hi":
        ok = r > one_s
    elif style == "bili":
        ok = (k <= 5) | (r > one_s)
    else:  # between, between_day1_plus1s
        ok = r >= one_s
    first_edge = width + (one_s if style == "between_day1_plus1s" else 0)
    return (
        F.when(delta_us <= first_edge, F.lit(1).cast("bigint"))
        .when((k <= n) & ok, k)
    )
