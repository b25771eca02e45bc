"""Exact medians without a buffer per group (A4).

``median`` as an aggregate keeps all values of a group in one task.  Here the values of
each group are counted first (combined before the shuffle, spread by group and value);
a running count over the values in balanced ranges (``sequence``) then tells which values
hold the middle ranks, and only those, at most two a group, are folded.  A group with a
third of all rows is spread like any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.operators.sequence import Keep, running_sum


def medians(df: DataFrame, keys: list[str], value: str, name: str = "median", keep: Keep | None = None) -> DataFrame:
    """One row per group that has a value: ``keys`` and the median, NULL values left out.

    Of an even number the mean of both middle values, as ``median`` gives it.  NULL keys
    are a group; NaN is the greatest value.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_sum(counts, keys, value, "_n", "_upto", keep)
    totals = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_all")).alias("t")
    same = [F.col(f"u.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    on = same[0]
    for cond in same[1:]:
        on = on & cond
    placed = upto.alias("u").join(totals, on).select(*[F.col(f"u.{k}") for k in keys], F.col(f"u.{value}").alias("_v"),
                                                     "_n", "_upto", "_all")
    lower, upper = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1  # ranks from 1
    holds = [(F.col("_upto") - F.col("_n") < rank) & (rank <= F.col("_upto")) for rank in (lower, upper)]
    middle = placed.where(holds[0] | holds[1]).groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    mean = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(0.5 * F.col("_lo") + 0.5 * F.col("_hi"))
    return middle.select(*keys, mean.alias(name))
