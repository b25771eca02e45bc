"""Window joins around a stay's admission (X1, J10-J12) and as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.functions.timeops import micros_between, US_PER_HOUR


def first_window(events: DataFrame, stays: DataFrame, before_hours: float,
                 after_hours: float, lower_open: bool = False, upper_open: bool = False,
                 time_col: str = "charttime", key: str | list[str] = "icustay_id",
                 stay_cols: tuple[str, ...] = ()) -> DataFrame:
    """Events of a stay whose time lies in a window around ``intime``.

    ``before_hours``/``after_hours`` bound the offset from ``intime``; each end
    is closed unless ``*_open``.  ``before_hours=None`` drops the lower bound.
    The join is an equi join on ``key`` (hash/sort-merge), the window is a
    residual predicate on microsecond offsets, so no theta join is planned.
    """
    keys = [key] if isinstance(key, str) else list(key)
    s = stays.select(*keys, "intime", *stay_cols)
    j = events.join(s, keys)
    d = micros_between(F.col("intime"), F.col(time_col))
    conds = []
    if before_hours is not None:
        lo = -int(before_hours * US_PER_HOUR)
        conds.append(d > lo if lower_open else d >= lo)
    if after_hours is not None:
        hi = int(after_hours * US_PER_HOUR)
        conds.append(d < hi if upper_open else d <= hi)
    for cnd in conds:
        j = j.where(cnd)
    return j


def in_window(ts: Column, start: Column, before_hours: float | None, after_hours: float | None,
              lower_open: bool = False, upper_open: bool = False) -> Column:
    """Predicate form of ``first_window`` for use inside a left join's ON."""
    d = micros_between(start, ts)
    cond = F.lit(True)
    if before_hours is not None:
        lo = -int(before_hours * US_PER_HOUR)
        cond = cond & (d > lo if lower_open else d >= lo)
    if after_hours is not None:
        hi = int(after_hours * US_PER_HOUR)
        cond = cond & (d < hi if upper_open else d <= hi)
    return cond


def asof_last(left: DataFrame, right: DataFrame, key: str, lookback_hours: float,
              right_values: list[str], time_col: str = "charttime",
              right_time_alias: str = "_asof_time") -> DataFrame:
    """For every left row, the latest right row of the same key within
    ``[t - lookback, t]`` (X6, J13); left rows without one get NULLs.

    No range join (which would pair every left row with every right row of
    the key before filtering): both sides are unioned and scanned in time
    order, and a RANGE frame over microseconds carries the max of
    ``struct(time, values)`` of right rows -- the latest right *row*, even when
    its value is NULL.  The scan is partitioned by (key, time bucket), buckets
    four lookbacks wide; a right row within one lookback of its bucket's end
    is also copied into the next bucket, so every left row finds all its
    candidates in its own bucket and a very long stay is spread over many
    tasks (about a quarter of the right rows are copied once).  Right times
    must be unique per key.
    """
    look_us = int(lookback_hours * US_PER_HOUR)
    width = 4 * look_us
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    us = micros_between(epoch, F.col(time_col))
    b = F.floor(us / width)
    lcols = list(left.columns)
    l_side = left.withColumn("_side", F.lit(0)).withColumn("_b", b)
    for c in right_values:
        l_side = l_side.withColumn(c, F.lit(None).cast(right.schema[c].dataType))
    near_end = us >= (b + 1) * width - look_us
    r_side = (right.where(F.col(key).isNotNull())  # a NULL key matches nothing
              .select(key, time_col, *right_values).withColumn("_side", F.lit(1))
              .withColumn("_b", F.explode(F.when(near_end, F.array(b, b + 1))
                                          .otherwise(F.array(b)))))
    both = l_side.unionByName(r_side, allowMissingColumns=True).withColumn("_us", us)
    frame = Window.partitionBy(key, "_b").orderBy("_us").rangeBetween(-look_us, 0)
    latest = F.max(F.when(F.col("_side") == 1,
                          F.struct(F.col(time_col).alias("t"),
                                   *[F.col(c).alias(c) for c in right_values]))).over(frame)
    out = both.withColumn("_latest", latest).where(F.col("_side") == 0)
    keep = [c for c in lcols if c not in right_values]
    return out.select(*keep, F.col("_latest.t").alias(right_time_alias),
                      *[F.col(f"_latest.{c}").alias(c) for c in right_values])
