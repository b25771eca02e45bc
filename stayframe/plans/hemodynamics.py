"""Haemodynamics per day (C15): MAP, CVP and perfusion pressure (MPP = MAP - CVP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.functions.timeops import day_bucket, hours_between, micros_between
from stayframe.operators.sequence import last_before
from stayframe.operators.twm import twm_value, with_nearest_neighbour_diff
from stayframe.plans.base import Concepts, concept

# Item ids and plausibility bounds (exclusive).
MAP_ITEMS = (456, 52, 6702, 443, 220052, 220181, 225312)
CVP_ITEMS = (220074, 113, 1103)
BOUNDS = (0, 200)
TYPES = ("MeanBP", "cvp", "elsenull")


@concept("mpp_nearest", """
    icustay_id bigint, itemid bigint, charttime timestamp_ntz, type string,
    mabp double, cvp double, mpp double""")
def mpp_nearest(c: Concepts):
    """Rows of MAP/CVP items with MPP from the nearer adjacent MAP."""
    lo, hi = BOUNDS
    v, item = F.col("valuenum"), F.col("itemid")
    rows = (c.t.chartevents.where(item.isin(*(MAP_ITEMS + CVP_ITEMS)))
            .join(c.get("cohort").select("icustay_id"), "icustay_id", "left_semi")
            .select("icustay_id", "itemid", "charttime", "row_id",
                    F.when(item.isin(*MAP_ITEMS) & (v > lo) & (v < hi), v).alias("mabp"),
                    F.when(item.isin(*CVP_ITEMS) & (v > lo) & (v < hi), v).alias("cvp"),
                    F.when(item.isin(*MAP_ITEMS), "MeanBP").when(item.isin(*CVP_ITEMS), "cvp")
                    .otherwise("elsenull").alias("type")))
    return with_nearest_neighbour_diff(rows, "icustay_id", ["charttime", "row_id"], target="cvp", other="mabp",
                                       name="mpp", keep=c.keep("pressure_rows"))


@concept("hemodyn_daily", """
    icustay_id bigint, day bigint, avg_mabp double, twm_mabp double, avg_cvp double,
    twm_cvp double, avg_mpp double, twm_mpp double""")
def hemodyn_daily(c: Concepts):
    rows = c.get("mpp_nearest")
    adm = c.get("cohort").select("icustay_id", "admittime")
    # weight = hours since the previous row of the same type (MAP rows after
    # MAP rows, CVP rows after CVP rows), from a scan over the ranges the rows are stored in
    order = ["charttime", "row_id"]
    rows = last_before(rows, ["icustay_id"], order,
                       {f"_prev_{typ}": F.col("type") == typ for typ in TYPES}, ["charttime"])
    prev = None
    for typ in TYPES:
        p = F.col(f"_prev_{typ}_charttime")
        prev = (F.when(F.col("type") == typ, p) if prev is None
                else prev.when(F.col("type") == typ, p))
    staged = (rows.join(adm, "icustay_id")
              .select("icustay_id", "type", "mabp", "cvp", "mpp",
                      day_bucket(micros_between(F.col("admittime"), F.col("charttime")),
                                 24, 7, "between").alias("day"),
                      hours_between(prev, F.col("charttime")).alias("w"))
              .where(F.col("day").isNotNull()))

    # one aggregation for the three measures; MAP rows only hold mabp, CVP rows
    # cvp and mpp, so the row type needs no key of its own
    names, w = ("mabp", "cvp", "mpp"), F.col("w")
    aggs = []
    for n in names:
        x = F.col(n)
        aggs += [F.avg(x).alias(f"avg_{n}"), F.max(x).alias(f"_max_{n}"), F.sum(x * w).alias(f"_svw_{n}"),
                 F.sum(F.when(x.isNotNull(), w)).alias(f"_sw_{n}")]
    days = staged.groupBy("icustay_id", "day").agg(*aggs)
    values = days.select("icustay_id", "day", *[c for n in names for c in (
        f"avg_{n}", twm_value(F.col(f"_sw_{n}"), F.col(f"_svw_{n}"), F.col(f"_max_{n}")).alias(f"twm_{n}"))])

    # CVP and MPP meet MAP days only; a day without MAP keeps one row for
    # each of them, a day without any value none
    def row(*shown):
        return F.struct(*[(F.col(f"{k}_{n}") if n in shown else F.lit(None).cast("double")).alias(f"{k}_{n}")
                          for n in names for k in ("avg", "twm")])

    def has(n):
        return F.col(f"avg_{n}").isNotNull()

    rows = F.array_compact(F.array(
        F.when(has("mabp"), row(*names)),
        F.when(~has("mabp") & has("cvp"), row("cvp")),
        F.when(~has("mabp") & has("mpp"), row("mpp"))))
    return values.select("icustay_id", "day", F.inline(rows))
