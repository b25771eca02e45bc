"""Mechanical ventilation (C5-C8): settings, episodes, cohort episodes, day flags."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayframe.operators.episodes import episode_rows, overlap_days, summarise_episodes
from stayframe.plans.base import Concepts, concept

# Item ids and texts that mark ventilation, extubation, oxygen.
VENT_SETTING_ITEMS = (
    445, 448, 449, 450, 1340, 1486, 1600, 224687,  # minute volume
    639, 654, 681, 682, 683, 684, 224685, 224684, 224686,  # tidal volume
    218, 436, 535, 444, 459, 224697, 224695, 224696, 224746, 224747,  # resp pressure
    221, 1, 1211, 1655, 2000, 226873, 224738, 224419, 224750, 227187,  # insp pressure
    543,  # plateau pressure
    5865, 5866, 224707, 224709, 224705, 224706,  # APRV pressure
    60, 437, 505, 506, 686, 220339, 224700,  # PEEP
    3459,  # high pressure relief
    501, 502, 503, 224702,  # PCV
    223, 667, 668, 669, 670, 671, 672,  # TCPCV
    157, 158, 1852, 3398, 3399, 3400, 3401, 3402, 3403, 3404, 8382, 227809, 227810,  # ETT
    224701,  # PSV level
)
OXYGEN_ITEMS = (468, 469, 470, 471, 227287, 226732, 223834)
VENT_SCAN_ITEMS = tuple(sorted(set(
    (648, 720, 223848, 640, 467) + VENT_SETTING_ITEMS + OXYGEN_ITEMS)))
O2_DEVICES_MV = (
    "Nasal cannula", "Face tent", "Aerosol-cool", "Trach mask ", "High flow neb",
    "Non-rebreather", "Venti mask ", "Medium conc mask ", "T-piece",
    "High flow nasal cannula", "Ultrasonic neb", "Vapomist",
)
O2_DEVICES_CV = (
    "Cannula", "Nasal Cannula", "None", "Face Tent", "Aerosol-Cool", "Trach Mask",
    "Hi Flow Neb", "Non-Rebreather", "Venti Mask", "Medium Conc Mask", "Vapotherm",
    "T-Piece", "Hood", "Hut", "TranstrachealCat", "Heated Neb", "Ultrasonic Neb",
)
EXTUBATION_PROCEDURES = (227194, 225468, 225477)
SELF_EXTUBATION_PROCEDURES = (225468, 225477)
MAX_GAP_HOURS = 8


def vent_flags(ce):
    """Per-row MechVent / Extubated / SelfExtubated flags of chart rows."""
    item, value = F.col("itemid"), F.col("value")
    mech = (
        F.when((item == 720) & (value != "Other/Remarks"), 1)
        .when((item == 223848) & (value != "Other"), 1)
        .when((item == 467) & (value == "Ventilator"), 1)
        .when((item == 648) & (value == "Intubated/trach"), 1)
        .when(item.isin(*VENT_SETTING_ITEMS), 1)
        .otherwise(0)
    )
    ext = (
        F.when((item == 640) & value.isin("Extubated", "Self Extubation"), 1)
        .when((item == 226732) & value.isin(*O2_DEVICES_MV), 1)
        .when((item == 467) & value.isin(*O2_DEVICES_CV), 1)
        .otherwise(0)
    )
    self_ext = F.when((item == 640) & (value == "Self Extubation"), 1).otherwise(0)
    return ce.select("icustay_id", "charttime", "itemid", mech.alias("mechvent"),
                     ext.alias("extubated"), self_ext.alias("selfextubated"))


@concept("vent_settings", """
    icustay_id bigint, charttime timestamp_ntz, mechvent int, extubated int,
    selfextubated int""")
def vent_settings(c: Concepts):
    stays = c.get("cohort").select("icustay_id")
    ce = (c.t.chartevents
          .where(F.col("value").isNotNull() & F.col("itemid").isNotNull()
                 & ~F.col("error").eqNullSafe(1) & F.col("itemid").isin(*VENT_SCAN_ITEMS))
          .join(stays, "icustay_id", "left_semi"))
    chart = (vent_flags(ce)
             .groupBy("icustay_id", "charttime", "itemid")
             .agg(F.max("mechvent").alias("mechvent"), F.max("extubated").alias("extubated"),
                  F.max("selfextubated").alias("selfextubated"))
             .drop("itemid"))
    pe = c.t.procedureevents_mv
    proc = (pe.where(F.col("itemid").isin(*EXTUBATION_PROCEDURES) & F.col("value").isNotNull())
            .join(stays, "icustay_id", "left_semi")
            .select("icustay_id", F.col("starttime").alias("charttime"),
                    F.lit(0).alias("mechvent"),
                    F.lit(1).alias("extubated"),
                    F.when(F.col("itemid").isin(*SELF_EXTUBATION_PROCEDURES), 1).otherwise(0)
                    .alias("selfextubated")))
    return chart.unionByName(proc).distinct()


@concept("vent_durations", """
    icustay_id bigint, ventnum bigint, starttime timestamp_ntz, endtime timestamp_ntz,
    duration_hours double""")
def vent_durations(c: Concepts):
    return summarise_episodes(c.get("vent_newevent"))


@concept("vent_newevent", """
    icustay_id bigint, charttime timestamp_ntz, mechvent int, extubated int,
    leadtime timestamp_ntz, newvent int, ventnum bigint""")
def vent_newevent(c: Concepts):
    return episode_rows(c.get("vent_settings"), on="mechvent", off="extubated",
                        max_gap_hours=MAX_GAP_HOURS,
                        tiebreak=("mechvent", "extubated", "selfextubated"),
                        keep=lambda name: c.keep(f"vent_{name}"))


@concept("cohort_episodes", """
    icustay_id bigint, subject_id bigint, hadm_id bigint, gender string, ethnicity string,
    admission_type string, admittime timestamp_ntz, dischtime timestamp_ntz,
    hospital_expire_flag string, icu_expire_flag string, hospstay_seq int,
    first_hosp_stay string, intime timestamp_ntz, outtime timestamp_ntz, age double,
    los_icu double, icustay_seq int, first_icu_stay string, weight double,
    ventnum bigint, starttime timestamp_ntz, endtime timestamp_ntz, duration_hours double""")
def cohort_episodes(c: Concepts):
    vd = c.get("vent_durations").where(F.col("ventnum") >= 1)
    return c.get("cohort").join(vd, "icustay_id")


@concept("vent_day_flags", """
    day int, icustay_id bigint, mechvent_flag string, mechvent_perday bigint""")
def vent_day_flags(c: Concepts):
    ep = c.get("cohort_episodes").select("icustay_id", "admittime", "starttime", "endtime")
    days = overlap_days(ep, origin="admittime", n_days=7)
    per_day = Window.partitionBy("icustay_id", "day")
    return days.select("day", "icustay_id", F.lit("Y").alias("mechvent_flag"),
                       F.count(F.lit(1)).over(per_day).alias("mechvent_perday"))
