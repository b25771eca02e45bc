"""Time-weighted daily means (X3) and the nearest-neighbour difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.functions.timeops import seconds_between
from stayframe.operators.sequence import scan


def twm_value(sum_w: Column, sum_vw: Column, max_v: Column) -> Column:
    """``sum(v*w)/sum(w)``, or ``max(v)`` when either sum is exactly 0.

    A NULL sum is *not* 0: ``x in (NULL, 0)`` is NULL for a NULL x, so such a
    group falls to the division and yields NULL.
    """
    return F.when((sum_w == 0) | (sum_vw == 0), max_v).otherwise(sum_vw / sum_w)


def with_nearest_neighbour_diff(df: DataFrame, key: str, order: list[str], target: str,
                                other: str, name: str, time_col: str = "charttime", keep=None) -> DataFrame:
    """Add ``name`` = ``other`` of the nearer adjacent row minus ``target`` (X7,
    MPP = MAP - CVP).

    Branches, first match wins: previous row strictly nearer with a value;
    next row nearer-or-equal with a value; two back strictly nearer than two
    ahead while the previous row has none; two ahead strictly nearer while the
    next row has none.  At the ends of a stay the comparisons are NULL and
    fall through.  The adjacent rows come from a scan over ranges of (stay,
    time), so a very long stay is not one task; the range column stays, for
    later scans of the same order.
    """
    nb = scan(df, [key], order, [time_col, other], prev=2, nxt=2, keep=keep)
    t = F.col(time_col)

    def dist(which: str) -> Column:
        return F.abs(seconds_between(F.col(f"{which}_{time_col}"), t))

    prev_v, next_v = F.col(f"prev1_{other}"), F.col(f"next1_{other}")
    prev2_v, next2_v = F.col(f"prev2_{other}"), F.col(f"next2_{other}")
    tv = F.col(target)
    diff = (
        F.when(tv.isNull(), None)
        .when((dist("next1") > dist("prev1")) & prev_v.isNotNull(), prev_v - tv)
        .when((dist("next1") <= dist("prev1")) & next_v.isNotNull(), next_v - tv)
        .when((dist("next2") > dist("prev2")) & prev_v.isNull(), prev2_v - tv)
        .when((dist("next2") < dist("prev2")) & next_v.isNull(), next2_v - tv)
    )
    helper = [f"{w}_{c}" for w in ("prev1", "prev2", "next1", "next2") for c in (time_col, other)]
    return nb.withColumn(name, diff).drop(*helper)
