"""Cohort selection (C1-C4, C26): demographics, eligibility, first-day weight."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.functions import text
from stayframe.functions.numeric import numeric_round
from stayframe.functions.timeops import micros_between, plus_days
from stayframe.operators.ranking import ranks
from stayframe.operators.selection import medians
from stayframe.operators.windows import first_window
from stayframe.plans.base import Concepts, concept

# Unit factor and item ids of the weight concept.
LB_TO_KG = 0.453592
ADMIT_WEIGHT_ITEMS = (762, 226512)
DAILY_WEIGHT_ITEMS = (763, 224639)


DEMOGRAPHICS_SCHEMA = """
    subject_id bigint, hadm_id bigint, icustay_id bigint, gender string, ethnicity string,
    admission_type string, admittime timestamp_ntz, dischtime timestamp_ntz,
    hospital_expire_flag string, icu_expire_flag string, hospstay_seq int,
    first_hosp_stay string, intime timestamp_ntz, outtime timestamp_ntz, age double,
    los_icu double, icustay_seq int, first_icu_stay string"""


@concept("demographics", DEMOGRAPHICS_SCHEMA)
def demographics(c: Concepts):
    t = c.t
    adm = t.admissions.where(F.col("has_chartevents_data") == 1).drop("subject_id")
    df = (t.icustays.join(adm, "hadm_id")
          .join(t.patients, "subject_id"))
    # an admission has one subject and one time, so its stays are neighbours in this order
    df = ranks(df, ["subject_id", "admittime", "hadm_id", "intime", "icustay_id"], {
        "_hospstay": (["subject_id"], ["admittime"]), "_stay": (["subject_id", "hadm_id"], None),
        "_intime": (["subject_id", "hadm_id"], ["intime"])}, keep=c.keep("stay_ranks"))
    death, intime, outtime = F.col("deathtime"), F.col("intime"), F.col("outtime")
    icu_expire = (
        F.when(death.between(intime, outtime), "Y")
        .when(death <= intime, "Y")
        .when((F.col("dischtime") <= outtime)
              & (F.col("discharge_location") == "DEAD/EXPIRED"), "Y")
        .otherwise("N")
    )
    hosp_rank = F.col("_hospstay")
    return df.select(
        "subject_id", "hadm_id", "icustay_id", "gender", "ethnicity", "admission_type",
        "admittime", "dischtime",
        F.when(death.isNotNull(), "Y").otherwise("N").alias("hospital_expire_flag"),
        icu_expire.alias("icu_expire_flag"),
        hosp_rank.alias("hospstay_seq"),
        F.when(hosp_rank == 1, "Y").otherwise("N").alias("first_hosp_stay"),
        "intime", "outtime",
        numeric_round(micros_between(F.col("dob"), intime) / 1e6 / 60 / 60 / 24 / 365.242, 4)
        .alias("age"),
        numeric_round(micros_between(intime, outtime) / 1e6 / 60 / 60 / 24, 4).alias("los_icu"),
        F.col("_stay").alias("icustay_seq"),
        F.when(F.col("_intime") == 1, "Y").otherwise("N").alias("first_icu_stay"),
    )


@concept("cohort_select", DEMOGRAPHICS_SCHEMA)
def cohort_select(c: Concepts):
    d = c.get("demographics")
    return d.where(
        (F.col("age") >= 18)
        & (F.col("first_icu_stay") == "Y")
        & F.col("admission_type").isin("URGENT", "EMERGENCY")
    )


@concept("echo_data", """
    row_id bigint, subject_id bigint, hadm_id bigint, chartdate date,
    charttime timestamp_ntz, indication string, height double, weight double,
    bsa double, bp string, bpsys double, bpdias double, hr double, status string,
    test string, doppler string, contrast string, technicalquality string""")
def echo_data(c: Concepts):
    notes = c.t.noteevents.where(F.col("category") == "Echo")
    return text.extract_fields(notes, text.ECHO_FIELDS)


# In the order of preference.
WEIGHT_SOURCES = ("weight_admit", "weight_daily", "weight_echoinhosp", "weight_echoprehosp")


def _charted_weights(c: Concepts, stays):
    """Admission and daily weights of the first day: (icustay_id, source, kg), one scan."""
    item = F.col("itemid")
    ev = (c.t.chartevents
          .where(item.isin(*ADMIT_WEIGHT_ITEMS, *DAILY_WEIGHT_ITEMS) & F.col("valuenum").isNotNull()
                 & (F.col("valuenum") != 0) & ~F.col("error").eqNullSafe(1))
          .select("icustay_id", "itemid", "charttime", "valuenum")
          .join(stays.select("icustay_id"), "icustay_id", "left_semi"))
    win = first_window(ev, c.t.icustays, before_hours=24, after_hours=24,
                       lower_open=True, upper_open=False)
    source = F.when(item.isin(*ADMIT_WEIGHT_ITEMS), "weight_admit").otherwise("weight_daily")
    return win.select("icustay_id", source.alias("source"), "valuenum")


def _echo_weights(c: Concepts, stays):
    """Echo weights (lb) of the stay, and of the month before it, as (icustay_id, source, valuenum)."""
    echo = c.get("echo_data").where(F.col("weight").isNotNull())
    ie = c.t.icustays.join(stays.select("icustay_id"), "icustay_id", "left_semi")
    in_hosp = (
        echo.where(F.col("hadm_id").isNotNull()).select("hadm_id", "charttime", "weight")
        .join(ie.select("icustay_id", "hadm_id", "intime"), "hadm_id")
        .where(F.col("charttime") < plus_days(F.col("intime"), 1))
    )
    pre_hosp = (
        echo.where(F.col("hadm_id").isNull()).select("subject_id", "charttime", "weight")
        .join(ie.select("icustay_id", "subject_id", "intime"), "subject_id")
        .where((F.col("intime") < F.col("charttime") + F.expr("INTERVAL 1 MONTH"))
               & (F.col("intime") > F.col("charttime")))
    )
    return [rows.select("icustay_id", F.lit(source).alias("source"), F.col("weight").alias("valuenum"))
            for rows, source in ((in_hosp, "weight_echoinhosp"), (pre_hosp, "weight_echoprehosp"))]


def weight_medians(rows, keep=None):
    """A median per (stay, source), echo weights in kg, in a column per source."""
    found = medians(rows, ["source", "icustay_id"], "valuenum", keep=keep)
    kg = F.when(F.col("source").startswith("weight_echo"), F.lit(LB_TO_KG) * F.col("median")).otherwise(F.col("median"))
    return found.groupBy("icustay_id").agg(
        *[F.max(F.when(F.col("source") == n, kg)).alias(n) for n in WEIGHT_SOURCES])


def weight_first_day_for(c: Concepts, stays):
    """X13 priority pick over four medians for the given stays."""
    in_hosp, pre_hosp = _echo_weights(c, stays)
    rows = _charted_weights(c, stays).unionByName(in_hosp).unionByName(pre_hosp)
    df = stays.select("subject_id", "icustay_id").join(
        weight_medians(rows, c.keep("weight_values")), "icustay_id", "left")
    # a source without rows has no median; its rows never hold a NULL weight
    return df.select("subject_id", "icustay_id",
                     numeric_round(F.coalesce(*WEIGHT_SOURCES), 2).alias("weight"), *WEIGHT_SOURCES)


WEIGHT_SCHEMA = """
    subject_id bigint, icustay_id bigint, weight double, weight_admit double,
    weight_daily double, weight_echoinhosp double, weight_echoprehosp double"""


@concept("weight_first_day", WEIGHT_SCHEMA)
def weight_first_day(c: Concepts):
    return weight_first_day_for(c, c.get("cohort_select"))


@concept("cohort", """
    subject_id bigint, hadm_id bigint, icustay_id bigint, gender string, ethnicity string,
    admission_type string, admittime timestamp_ntz, dischtime timestamp_ntz,
    hospital_expire_flag string, icu_expire_flag string, hospstay_seq int,
    first_hosp_stay string, intime timestamp_ntz, outtime timestamp_ntz, age double,
    los_icu double, icustay_seq int, first_icu_stay string, weight double""")
def cohort(c: Concepts):
    """Eligible stays of patients never coded 5859 (F13: null-aware NOT IN)."""
    sel = c.get("cohort_select")
    ckd = c.t.diagnoses_icd.where(F.col("icd9_code") == "5859").select("subject_id")
    kept = not_in(sel, ckd, "subject_id")
    w = c.get("weight_first_day").select("icustay_id", "weight")
    return kept.join(w, "icustay_id").select(sel.columns + ["weight"])


def not_in(df, excluded, key: str):
    """``df.key NOT IN (select key from excluded)`` with SQL null semantics.

    A NULL in ``excluded`` empties the result; a NULL ``df.key`` passes only
    when ``excluded`` is empty.  Both facts are scalar subqueries of the plan;
    the exclusion itself is an equi anti join on ``key`` (hash or sort-merge,
    never a nested loop), which keeps rows with a NULL key.
    """
    keys = excluded.select(key)
    facts = keys.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("known"))
    n, known = facts.select("n").scalar(), facts.select("known").scalar()
    return (df.join(keys, key, "left_anti")
            .where((n == known) & (F.col(key).isNotNull() | (n == 0))))
