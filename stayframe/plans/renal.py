"""Kidney concepts (C18-C23): creatinine, urine output, RRT, KDIGO stages.

Creatinine, urine and RRT join their events to the cohort by *patient*
(``subject_id``): events of other admissions of the same patient are taken in,
and everything before admission falls into day 1 (the buckets have no lower
bound).  That is the reference's behaviour and is kept.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayframe.functions.numeric import power
from stayframe.functions.rules import rule_column
from stayframe.plans import score_rules as rules
from stayframe.functions.timeops import day_bucket, micros_between
from stayframe.plans.base import Concepts, concept

# Item ids, unit factor, RRT texts, urine items.
CREATININE_ITEMS = (50912, 51081)
CREAT_MG_DL_TO_UMOL_L = 88
RRT_FLAG_ITEMS = (152, 148, 149, 146, 147, 151, 150)
RRT_LINE_ITEMS = (229, 235, 241, 247, 253, 259, 265, 271)
RRT_PROCEDURE_ITEM = 582
RRT_PROCEDURE_VALUES = ("CAVH Start", "CAVH D/C", "CVVHD Start", "CVVHD D/C",
                        "Hemodialysis st", "Hemodialysis end")
RRT_SCAN_ITEMS = RRT_FLAG_ITEMS + RRT_LINE_ITEMS + (RRT_PROCEDURE_ITEM,)
URINE_ITEMS = (
    40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086,
    40096, 40651, 226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557,
    226558, 227488, 227489,
)
IRRIGANT_OUT = 227489  # counted negative


def _by_patient(c: Concepts, events, cols):
    demo = c.get("cohort").select("subject_id", "icustay_id", "admittime", *cols)
    return events.join(demo, "subject_id")


def _day(width: int = 24, n: int = 7):
    return day_bucket(micros_between(F.col("admittime"), F.col("charttime")), width, n,
                      "between")


@concept("creat_daily", "icustay_id bigint, creat double, day bigint")
def creat_daily(c: Concepts):
    lab = c.t.labevents.where(F.col("itemid").isin(*CREATININE_ITEMS))
    j = _by_patient(c, lab.select("subject_id", "charttime", "valuenum"), [])
    return (j.select("icustay_id", (F.col("valuenum") * CREAT_MG_DL_TO_UMOL_L).alias("creat"),
                     _day().alias("day"))
            .where(F.col("day").isNotNull())
            .groupBy("icustay_id", "day").agg(F.max("creat").alias("creat")))


def rrt_flag():
    item, value = F.col("itemid"), F.col("value")
    return (F.when(item.isin(*RRT_FLAG_ITEMS) & value.isNotNull(), 1)
            .when(item.isin(*RRT_LINE_ITEMS) & (value == "Dialysis Line"), 1)
            .when((item == RRT_PROCEDURE_ITEM) & value.isin(*RRT_PROCEDURE_VALUES), 1)
            .otherwise(0))


@concept("rrt_daily", "icustay_id bigint, rrt int, day bigint")
def rrt_daily(c: Concepts):
    ce = c.t.chartevents.where(F.col("itemid").isin(*RRT_SCAN_ITEMS))
    j = _by_patient(c, ce.select("subject_id", "charttime", "itemid", "value"), [])
    return (j.select("icustay_id", rrt_flag().alias("rrt"), _day().alias("day"))
            .where(F.col("day").isNotNull())
            .groupBy("icustay_id", "day").agg(F.max("rrt").alias("rrt")))


@concept("urine_binned", """
    icustay_id bigint, day_6h bigint, day_12h bigint, day_24h bigint, urine_6h_kgh double,
    urine_12h_kgh double, urine_24h_kgh double""")
def urine_binned(c: Concepts):
    """6-h sums, rolled up to 12 h and 24 h, per kg and hour (A10).

    The 12-h and 24-h sums re-aggregate the 6-h partial sums with windows over
    the (small) 6-h table instead of re-reading events; a NULL bin matches
    nothing in the reference's join-back, so it gives NULL here too.
    """
    oe = c.t.outputevents.where(F.col("itemid").isin(*URINE_ITEMS))
    urine = F.when(F.col("itemid") == IRRIGANT_OUT, -1 * F.col("value")).otherwise(F.col("value"))
    j = _by_patient(c, oe.select("subject_id", "charttime", "itemid", "value"), [])
    binned = (j.select("icustay_id", urine.alias("urine"),
                       _day(24, 7).alias("day_24h"), _day(6, 28).alias("day_6h"),
                       _day(12, 14).alias("day_12h"))
              .where(F.col("day_24h").isNotNull())
              .groupBy("icustay_id", "day_6h", "day_12h", "day_24h")
              .agg(F.sum("urine").alias("urine_6h")))
    w12 = Window.partitionBy("icustay_id", "day_12h")
    w24 = Window.partitionBy("icustay_id", "day_24h")
    rolled = binned.select(
        "icustay_id", "day_6h", "day_12h", "day_24h", "urine_6h",
        F.when(F.col("day_12h").isNotNull(), F.sum("urine_6h").over(w12)).alias("urine_12h"),
        F.when(F.col("day_24h").isNotNull(), F.sum("urine_6h").over(w24)).alias("urine_24h"))
    weight = c.get("cohort").select("icustay_id", "weight")
    wt = F.col("weight")
    return rolled.join(weight, "icustay_id").select(
        "icustay_id", "day_6h", "day_12h", "day_24h",
        F.try_divide(F.col("urine_6h") / 6, wt).alias("urine_6h_kgh"),
        F.try_divide(F.col("urine_12h") / 12, wt).alias("urine_12h_kgh"),
        F.try_divide(F.col("urine_24h") / 24, wt).alias("urine_24h_kgh"))


@concept("urine_pivot", """
    icustay_id bigint, day_24h bigint, urine_24h_kgh double, urine_12h_kgh_1 double,
    urine_12h_kgh_2 double, urine_6h_kgh_1 double, urine_6h_kgh_2 double,
    urine_6h_kgh_3 double, urine_6h_kgh_4 double""")
def urine_pivot(c: Concepts):
    """One row per (stay, day) with its 24-h, two 12-h and four 6-h rates.

    The first 12-h slot is filled only when the day's smallest 12-h bin
    integer-divided by the day is 1, the second when its largest gives 2
    (N10: integer division); the 6-h slots go by bin number mod 4.
    """
    u = c.get("urine_binned")
    d12, d24, d6 = F.col("day_12h"), F.col("day_24h"), F.col("day_6h")
    g = u.groupBy("icustay_id", "day_24h").agg(
        F.max("urine_24h_kgh").alias("urine_24h_kgh"),
        F.min(d12).alias("_min12"), F.max(d12).alias("_max12"),
        F.max(F.when(F.expr("day_12h div day_24h") == 1, F.col("urine_12h_kgh")))
        .alias("_u12a"),
        F.max(F.when(F.expr("day_12h div day_24h") == 2, F.col("urine_12h_kgh")))
        .alias("_u12b"),
        *[F.max(F.when((d6 - 1) % 4 == k - 1, F.col("urine_6h_kgh"))).alias(f"urine_6h_kgh_{k}")
          for k in range(1, 5)])
    return g.select(
        "icustay_id", "day_24h", "urine_24h_kgh",
        F.when(F.expr("_min12 div day_24h") == 1, F.col("_u12a")).alias("urine_12h_kgh_1"),
        F.when(F.expr("_max12 div day_24h") == 2, F.col("_u12b")).alias("urine_12h_kgh_2"),
        *[f"urine_6h_kgh_{k}" for k in range(1, 5)])


KDIGO_SCHEMA = """
    icustay_id bigint, day_24h bigint, day_12h bigint, day_6h bigint, creat_max double,
    urine_6h_kgh double, urine_12h_kgh double, urine_24h_kgh double, rrt int, age double,
    ethnicity string, gender string, mdrd_creat75 double, kdigo int, changein_creat double"""


def mdrd_creat75(age, gender, ethnicity):
    """Baseline creatinine (µmol/L) for an eGFR of 75 by MDRD (KDIGO).

    Factors multiply left to right as written in the rule, so both engines
    round the same way.
    """
    black = "BLACK/AFRICAN AMERICAN"

    def base(*factors):
        denom = 186 * power(age, -0.203)
        for f in factors:
            denom = denom * f
        return 88 * power(75 / denom, 1 / -1.154)

    return (F.when((gender == "M") & (ethnicity == black), base(1.210))
            .when((gender == "M") & (ethnicity != black), base())
            .when((gender == "F") & (ethnicity != black), base(0.742))
            .otherwise(base(1.210, 0.742)))


@concept("kdigo_stage", KDIGO_SCHEMA)
def kdigo_stage_concept(c: Concepts):
    creat = c.get("creat_daily").select(F.col("icustay_id").alias("_ic"),
                                        F.col("day").alias("_dc"), "creat")
    urine = c.get("urine_binned").withColumnRenamed("icustay_id", "_iu")
    rrt = c.get("rrt_daily").select(F.col("icustay_id").alias("_ir"),
                                    F.col("day").alias("_dr"), "rrt")
    # Urine and rrt both join against creatinine's keys only.
    j = creat.join(urine, (creat["_ic"] == urine["_iu"]) & (creat["_dc"] == urine["day_24h"]),
                   "full_outer")
    j = j.join(rrt, (j["_ic"] == rrt["_ir"]) & (j["_dc"] == rrt["_dr"]), "full_outer")
    tab1 = j.select(
        F.coalesce("_ic", "_iu", "_ir").alias("icustay_id"),
        F.coalesce("day_24h", "_dc", "_dr").alias("day_24h"),
        "day_12h", "day_6h", F.col("creat").alias("creat_max"),
        "urine_6h_kgh", "urine_12h_kgh", "urine_24h_kgh", "rrt")
    demo = c.get("cohort").select("icustay_id", "age", "ethnicity", "gender")
    tab2 = tab1.join(demo, "icustay_id")
    mdrd = mdrd_creat75(F.col("age"), F.col("gender"), F.col("ethnicity"))
    tab3 = tab2.withColumn("mdrd_creat75", mdrd)
    ratio = F.col("creat_max") / F.col("mdrd_creat75")
    stage = rule_column(*rules.KDIGO)
    return tab3.select("*", stage.alias("kdigo"), ratio.alias("changein_creat")).distinct()


@concept("kdigo_daily", """
    icustay_id bigint, day_24h bigint, max_kdigo_24h int, avg_kdigo_24h double,
    min_kdigo_24h int""")
def kdigo_daily(c: Concepts):
    return c.get("kdigo_stage").groupBy("icustay_id", "day_24h").agg(
        F.max("kdigo").alias("max_kdigo_24h"), F.avg("kdigo").alias("avg_kdigo_24h"),
        F.min("kdigo").alias("min_kdigo_24h"))
