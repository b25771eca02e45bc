"""Day-bucket styles (X2) against a brute-force reading of the CASE chains."""

import pytest
from pyspark.sql import functions as F

from stayframe.functions.timeops import day_bucket

S = 1_000_000
H = 3600 * S
OFFSETS = [-H, 0, 24 * H, 24 * H + S // 2, 24 * H + S, 24 * H + 2 * S, 48 * H, 48 * H + S,
           120 * H, 120 * H + S, 120 * H + 2 * S, 144 * H + S // 2, 168 * H, 168 * H + S,
           170 * H]


def brute(d, style, width_h=24, n=7):
    w = width_h * H
    first = w + (S if style == "between_day1_plus1s" else 0)
    if d <= first:
        return 1
    for k in range(2, n + 1):
        lo, hi = (k - 1) * w, k * w
        if style == "open":
            ok = lo + S < d < hi
        elif style == "half_mixed":
            ok = (lo < d < hi) if k <= 5 else (lo + S < d < hi)
        elif style == "closed_hi":
            ok = lo + S < d <= hi
        elif style == "bili":
            ok = (lo < d <= hi) if k <= 5 else (lo + S < d <= hi)
        else:
            ok = lo + S <= d <= hi
        if ok:
            return k
    return None


@pytest.mark.parametrize("style", ["open", "half_mixed", "closed_hi", "bili", "between",
                                   "between_day1_plus1s"])
def test_day_bucket_styles(spark, style):
    df = spark.createDataFrame([(d,) for d in OFFSETS], "d long")
    got = {r.d: r.b for r in df.select("d", day_bucket(F.col("d"), 24, 7, style).alias("b"))
           .collect()}
    assert got == {d: brute(d, style) for d in OFFSETS}


def test_six_hour_bins(spark):
    offs = [0, 6 * H, 6 * H + S, 12 * H, 167 * H, 168 * H, 168 * H + S]
    df = spark.createDataFrame([(d,) for d in offs], "d long")
    got = {r.d: r.b for r in df.select("d", day_bucket(F.col("d"), 6, 28).alias("b")).collect()}
    assert got == {d: brute(d, "between", 6, 28) for d in offs}


@pytest.mark.parametrize("style", ["open", "half_mixed", "closed_hi", "bili", "between"])
def test_day_bucket_random_offsets_monotone(spark, style):
    """Random offsets (many near bucket edges): brute-force agreement, and the
    bucket never decreases as the offset grows (SURVEY §5 property)."""
    import random
    rnd = random.Random(17)
    edges = [k * 24 * H for k in range(0, 9)]
    offs = sorted({rnd.choice(edges) + rnd.randint(-3 * S, 3 * S) for _ in range(300)}
                  | {rnd.randint(-30 * H, 200 * H) for _ in range(300)})
    df = spark.createDataFrame([(d,) for d in offs], "d long")
    got = {r.d: r.b for r in df.select("d", day_bucket(F.col("d"), 24, 7, style).alias("b"))
           .collect()}
    assert got == {d: brute(d, style) for d in offs}
    seen = [got[d] for d in offs if got[d] is not None]
    assert seen == sorted(seen)
