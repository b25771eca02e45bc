"""The final wide table (C24): one row per ventilated cohort stay and day 1..7.

Plan shape: stay-level scores join the cohort first, all stored in equally
many buckets of the stay; the (stay, day) spine is then generated per stay row
(no cross join) and shuffled once by that pair, in which the per-day concepts
are bucketed, so no per-day join shuffles either side.  Only the day flags,
which hold a row per episode, are shuffled, and they come last.  Fan-out from several rows per (stay, day) on the right
(PEEP item ids, split haemodynamic days, repeated ventilation flags) is the
reference's behaviour and is kept.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.plans.base import Concepts, SCHEMAS, concept

N_DAYS = 7

@concept("day_spine", "day bigint, icustay_id bigint")
def day_spine(c: Concepts):
    """Days 1..7 for every cohort stay (X15, J4 without a cross join)."""
    return c.get("cohort").select(
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(N_DAYS).cast("bigint")))
        .alias("day"), "icustay_id")


_DRUG_ORDER = ("dobutamine", "dopamine", "epi", "norepi", "vasopressine")

GLOBAL_SCHEMA = (
    "day bigint, " + ", ".join(f"{n} {t}" for n, t in SCHEMAS["cohort"]) + """,
    sofa int, sofa_respi int, sofa_coag int, sofa_liver int, sofa_cv int, sofa_neuro int,
    sofa_renal int, sapsii int, apsiii int, avg_mabp double, twm_mabp double, avg_cvp double,
    twm_cvp double, avg_mpp double, twm_mpp double, dobutamine int, dopamine int, epi int,
    norepi int, vasopressine int, avg_peep double, max_peep double, peep_time double,
    peep_twm double, avg_paw double, max_paw double, paw_time double, paw_twm double,
    avg_pplat double, max_pplat double, pplat_time double, pplat_twm double, creat double,
    urine_24h_kgh double, urine_12h_kgh_1 double, urine_12h_kgh_2 double,
    urine_6h_kgh_1 double, urine_6h_kgh_2 double, urine_6h_kgh_3 double,
    urine_6h_kgh_4 double, rrt int, max_kdigo_24h int, mechvent_flag string,
    mechvent_perday bigint""")


@concept("global_merge", GLOBAL_SCHEMA)
def global_merge(c: Concepts):
    col = F.col
    keys = ["icustay_id", "day"]
    cohort = c.get("cohort")
    ventilated = c.stay_row(c.get("cohort_episodes").select("icustay_id").distinct())
    stays = cohort.join(ventilated, "icustay_id", "left_semi")
    so = c.get("sofa").select(
        "icustay_id", "sofa", col("respiration").alias("sofa_respi"),
        col("coagulation").alias("sofa_coag"), col("liver").alias("sofa_liver"),
        col("cardiovascular").alias("sofa_cv"), col("cns").alias("sofa_neuro"),
        col("renal").alias("sofa_renal"))
    saps = c.get("sapsii").select("icustay_id", "sapsii")
    aps = c.get("apsiii").select("icustay_id", "apsiii")
    hemo = c.get("hemodyn_daily")
    # several drugs, and the two pressures of a single item, in one row per day
    drugs = c.get("vasopressor_daily").groupBy(*keys).agg(
        *[F.max(F.when(col("drug") == d, col("flag"))).alias(d) for d in _DRUG_ORDER])
    measures = {"avg_{}": "avg_value", "max_{}": "max_value", "{}_time": "value_time", "{}_twm": "twm"}
    airway = (c.get("twm_daily").where(col("concept").isin("paw", "pplat") & col("day").isNotNull())
              .groupBy(*keys).agg(*[F.max(F.when(col("concept") == n, col(v))).alias(k.format(n))
                                    for n in ("paw", "pplat") for k, v in measures.items()]))
    peep = c.get("table_peep")  # a row per item: its fan-out is part of the result
    creat = c.get("creat_daily").select("icustay_id", "day", "creat")
    urine = c.get("urine_pivot").withColumnRenamed("day_24h", "day")
    rrt = c.get("rrt_daily").select("icustay_id", "day", "rrt")
    kdigo = c.get("kdigo_daily").select("icustay_id", col("day_24h").alias("day"),
                                        "max_kdigo_24h")
    flags = c.get("vent_day_flags").select("icustay_id", col("day").cast("bigint").alias("day"),
                                           "mechvent_flag", "mechvent_perday")
    # Stay-level scores join before the days are generated, so that every
    # later join runs on one (icustay_id, day) partitioning.
    per_stay = (stays.join(so, "icustay_id", "left").join(saps, "icustay_id", "left")
                .join(aps, "icustay_id", "left"))
    df = per_stay.withColumn("day", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                                         F.lit(N_DAYS).cast("bigint"))))
    df = c.aligned(df, *keys).join(hemo, keys, "left")
    for right in (drugs, peep, airway, creat, urine, rrt, kdigo, flags):
        df = df.join(right, keys, "left")
    return df
