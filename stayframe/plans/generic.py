"""Single-operator queries over the event tables (F4, F7, F8, F12, F14, J10,
J12, M6): the building blocks the concept pipelines repeat, exposed on their
own so each can be checked against the oracle in isolation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.operators.pivot import case_map
from stayframe.operators.windows import first_window
from stayframe.plans.base import Concepts, concept
from stayframe.plans.firstday import (FAHRENHEIT_ITEMS, HEIGHT_INCH_ITEMS, IN_TO_CM,
                                      LAB_LABELS, VITALS, _lab_clean)
from stayframe.plans.renal import CREAT_MG_DL_TO_UMOL_L, CREATININE_ITEMS
from stayframe.plans.severity import LB_TO_KG_EXACT, LB_WEIGHT_ITEM, OZ_TO_KG, OZ_WEIGHT_ITEM

VITAL_LABELS = {ids: name.split("_")[0] for name, ids, _, _ in VITALS}


@concept("valid_rows", """
    itemid bigint, n_rows bigint, n_valid bigint, n_error bigint, n_null_error bigint""")
def valid_rows(c: Concepts):
    """Per item: rows kept by ``error IS DISTINCT FROM 1`` (F7, N1: NULL is valid)."""
    valid = ~F.col("error").eqNullSafe(1)
    return c.t.chartevents.groupBy("itemid").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(valid, 1)).alias("n_valid"),
        F.count(F.when(F.col("error") == 1, 1)).alias("n_error"),
        F.count(F.when(F.col("error").isNull(), 1)).alias("n_null_error"))


@concept("cohort_semi", """
    icustay_id bigint, itemid bigint, n_rows bigint, first_time timestamp_ntz,
    last_time timestamp_ntz""")
def cohort_semi(c: Concepts):
    """Chart rows of cohort stays only (F12: semi join, cohort broadcast when small)."""
    ce = c.t.chartevents.join(c.get("cohort").select("icustay_id"), "icustay_id", "left_semi")
    return ce.groupBy("icustay_id", "itemid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("charttime").alias("first_time"),
        F.max("charttime").alias("last_time"))


@concept("item_map_filter", """
    row_id bigint, icustay_id bigint, itemid bigint, charttime timestamp_ntz, label string,
    valuenum double""")
def item_map_filter(c: Concepts):
    """Item-list filter plus item -> label map (F4), pushed into the scan."""
    items = sorted({i for ids in VITAL_LABELS for i in ids})
    ce = c.t.chartevents.where(F.col("itemid").isin(*items))
    return ce.select("row_id", "icustay_id", "itemid", "charttime",
                     case_map(F.col("itemid"), VITAL_LABELS).alias("label"), "valuenum")


@concept("plausibility_clean", """
    row_id bigint, subject_id bigint, hadm_id bigint, itemid bigint, charttime timestamp_ntz,
    valuenum double, clean_value double""")
def plausibility_clean(c: Concepts):
    """Lab values outside their plausible range become NULL (F8)."""
    le = c.t.labevents.where(F.col("itemid").isin(*LAB_LABELS))
    return le.select("row_id", "subject_id", "hadm_id", "itemid", "charttime", "valuenum",
                     _lab_clean(F.col("itemid"), F.col("valuenum")).alias("clean_value"))


@concept("unit_normalise", """
    row_id bigint, itemid bigint, valuenum double, unit string, normalised double""")
def unit_normalise(c: Concepts):
    """Unit conversions (M6): lb/oz -> kg, in -> cm, °F -> °C; creatinine -> µmol/L."""
    item, v = F.col("itemid"), F.col("valuenum")
    chart_items = (LB_WEIGHT_ITEM, OZ_WEIGHT_ITEM) + HEIGHT_INCH_ITEMS + FAHRENHEIT_ITEMS
    ce = c.t.chartevents.where(item.isin(*chart_items)).select(
        "row_id", "itemid", "valuenum",
        F.when(item == LB_WEIGHT_ITEM, "kg").when(item == OZ_WEIGHT_ITEM, "kg")
        .when(item.isin(*HEIGHT_INCH_ITEMS), "cm").otherwise("degC").alias("unit"),
        F.when(item == LB_WEIGHT_ITEM, v * LB_TO_KG_EXACT).when(item == OZ_WEIGHT_ITEM, v * OZ_TO_KG)
        .when(item.isin(*HEIGHT_INCH_ITEMS), v * IN_TO_CM).otherwise((v - 32) / 1.8)
        .alias("normalised"))
    le = c.t.labevents.where(item.isin(*CREATININE_ITEMS)).select(
        "row_id", "itemid", "valuenum", F.lit("umol/L").alias("unit"),
        (v * CREAT_MG_DL_TO_UMOL_L).alias("normalised"))
    return ce.unionByName(le)


@concept("first_per_group", """
    icustay_id bigint, itemid bigint, charttime timestamp_ntz, valuenum double""")
def first_per_group(c: Concepts):
    """First charted row per (stay, item): the ``row_number() = 1`` pick of a
    window (F14, W2), computed as ``min(struct(time, row_id, value))`` so the
    pick combines map-side and a hot (stay, item) group is not one task."""
    first = F.min(F.struct("charttime", "row_id", "valuenum")).alias("_f")
    return (c.t.chartevents.groupBy("icustay_id", "itemid").agg(first)
            .select("icustay_id", "itemid", "_f.charttime", "_f.valuenum"))


@concept("first_day_window", """
    icustay_id bigint, itemid bigint, n_rows bigint, min_value double, max_value double""")
def first_day_window(c: Concepts):
    """Chart rows in [intime, intime + 1 day] per stay and item."""
    ce = c.t.chartevents.select("icustay_id", "itemid", "charttime", "valuenum")
    j = first_window(ce, c.t.icustays, 0, 24)
    return j.groupBy("icustay_id", "itemid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("valuenum").alias("min_value"),
        F.max("valuenum").alias("max_value"))


@concept("weight_echo_prehosp", "icustay_id bigint, weight_echoprehosp double")
def weight_echo_prehosp(c: Concepts):
    """Echo weights from the calendar month before ICU admission."""
    from stayframe.plans.cohort import _echo_weights, weight_medians
    _, pre = _echo_weights(c, c.t.icustays.select("subject_id", "icustay_id"))
    return weight_medians(pre, c.keep("prehosp_values")).select("icustay_id", "weight_echoprehosp")
