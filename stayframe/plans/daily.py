"""Per-day presence and maxima (C16 liver enzymes, C17 vasopressors)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.functions.timeops import day_bucket, micros_between
from stayframe.plans.base import Concepts, concept

# Enzyme -> (item ids, day style, stays table).
ENZYMES = {
    "asat": ((769,), "closed_hi", "cohort_episodes"),
    "alat": ((770,), "closed_hi", "cohort_episodes"),
    "alp": ((773,), "closed_hi", "cohort_episodes"),
    "bili": ((1538, 225690), "bili", "cohort"),
}
# Vasopressor -> (CareVue item ids, day style).
VASOPRESSORS = {
    "norepi": ((30047, 30120), "between"),
    "epi": ((30044, 30119, 30309), "between"),
    "dopamine": ((30043, 30307), "between"),
    "dobutamine": ((30042, 30306), "between"),
    "vasopressine": ((30051,), "between_day1_plus1s"),
}


def _by_name(item_col, table: dict):
    expr = None
    for name, spec in table.items():
        cond = item_col.isin(*spec[0])
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def _day_by_name(delta, name_col, table: dict, style_pos: int):
    expr = None
    for name, spec in table.items():
        b = day_bucket(delta, 24, 7, spec[style_pos])
        expr = F.when(name_col == name, b) if expr is None else expr.when(name_col == name, b)
    return expr


@concept("enzyme_daily_max", """
    enzyme string, icustay_id bigint, day bigint, max_value double""")
def enzyme_daily_max(c: Concepts):
    """Daily max of ASAT/ALAT/ALP (episode stays) and bilirubin (cohort stays).

    ASAT/ALAT/ALP are read through the cohort x episodes table; a stay with
    several episodes repeats its rows there, which the max absorbs, so a
    semi join on the episode stays gives the same groups without the fan-out.
    Bilirubin keeps one row per item id (the hidden group key).
    """
    items = sorted({i for s in ENZYMES.values() for i in s[0]})
    adm = c.get("cohort").select("icustay_id", "admittime")
    ep_stays = c.get("cohort_episodes").select("icustay_id")
    ce = (c.t.chartevents.where(F.col("itemid").isin(*items))
          .join(adm, "icustay_id")
          .withColumn("enzyme", _by_name(F.col("itemid"), ENZYMES)))
    on_episode = ce.join(ep_stays.distinct(), "icustay_id", "left_semi")
    needs_episode = F.col("enzyme").isin(
        *[n for n, s in ENZYMES.items() if s[2] == "cohort_episodes"])
    rows = on_episode.where(needs_episode).unionByName(ce.where(~needs_episode))
    delta = micros_between(F.col("admittime"), F.col("charttime"))
    day = _day_by_name(delta, F.col("enzyme"), ENZYMES, 1)
    return (rows.withColumn("day", day).where(F.col("day").isNotNull())
            .groupBy("enzyme", "icustay_id", "day", "itemid")
            .agg(F.max("valuenum").alias("max_value"))
            .drop("itemid"))


@concept("vasopressor_daily", """
    drug string, icustay_id bigint, day bigint, flag int""")
def vasopressor_daily(c: Concepts):
    """Days with at least one CareVue infusion row of each drug (value 1).

    The reference's per-stay self join of event flags only feeds ``sum > 0``,
    which is 1 for every (stay, day) that has a row; the join is dropped.
    """
    items = sorted({i for s in VASOPRESSORS.values() for i in s[0]})
    adm = c.get("cohort").select("icustay_id", "admittime")
    iv = (c.t.inputevents_cv.where(F.col("itemid").isin(*items))
          .join(adm, "icustay_id")
          .withColumn("drug", _by_name(F.col("itemid"), VASOPRESSORS)))
    delta = micros_between(F.col("admittime"), F.col("charttime"))
    day = _day_by_name(delta, F.col("drug"), VASOPRESSORS, 1)
    return (iv.select("drug", "icustay_id", day.alias("day"))
            .where(F.col("day").isNotNull())
            .distinct()
            .withColumn("flag", F.lit(1)))
