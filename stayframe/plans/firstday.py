"""First-ICU-day concepts (C27-C36) over all stays: vitals, labs, blood gases,
GCS, urine, ventilation, height, weight, RRT."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.functions.timeops import micros_between, plus_days, US_PER_HOUR
from stayframe.operators.pivot import case_map, pivot_aggs
from stayframe.operators.sequence import neighbours
from stayframe.operators.selection import medians
from stayframe.operators.windows import asof_last, first_window, in_window
from stayframe.plans.base import Concepts, concept
from stayframe.plans.cohort import weight_first_day_for
from stayframe.plans.renal import URINE_ITEMS, IRRIGANT_OUT

# ---------------------------------------------------------------------------
# Vital signs (label, item ids, bounds).  Bounds are exclusive
# (SpO2's upper bound is inclusive) and apply to the value as charted;
# Fahrenheit temperatures are converted to Celsius afterwards.
# ---------------------------------------------------------------------------
VITALS = (
    ("heartrate", (211, 220045), 0, 300),
    ("sysbp", (51, 442, 455, 6701, 220179, 220050), 0, 400),
    ("diasbp", (8368, 8440, 8441, 8555, 220180, 220051), 0, 300),
    ("meanbp", (456, 52, 6702, 443, 220052, 220181, 225312), 0, 300),
    ("resprate", (615, 618, 220210, 224690), 0, 70),
    ("tempc_f", (223761, 678), 70, 120),
    ("tempc_c", (223762, 676), 10, 50),
    ("spo2", (646, 220277), 0, 100),
    ("glucose", (807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0, None),
)
VITAL_IDS = {"heartrate": 1, "sysbp": 2, "diasbp": 3, "meanbp": 4, "resprate": 5,
             "tempc_f": 6, "tempc_c": 6, "spo2": 7, "glucose": 8}
VITAL_NAMES = ("heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2",
               "glucose")
FAHRENHEIT_ITEMS = (223761, 678)

# First-day labs (item -> label) and upper plausibility bounds.
LAB_LABELS = {
    50868: "aniongap", 50862: "albumin", 51144: "bands", 50882: "bicarbonate",
    50885: "bilirubin", 50912: "creatinine", 50806: "chloride", 50902: "chloride",
    50809: "glucose", 50931: "glucose", 50810: "hematocrit", 51221: "hematocrit",
    50811: "hemoglobin", 51222: "hemoglobin", 50813: "lactate", 51265: "platelet",
    50822: "potassium", 50971: "potassium", 51275: "ptt", 51237: "inr", 51274: "pt",
    50824: "sodium", 50983: "sodium", 51006: "bun", 51300: "wbc", 51301: "wbc",
}
LAB_UPPER = {
    50862: 10, 50868: 10000, 51144: 100, 50882: 10000, 50885: 150, 50806: 10000,
    50902: 10000, 50912: 150, 50809: 10000, 50931: 10000, 50810: 100, 51221: 100,
    50811: 50, 51222: 50, 50813: 50, 51265: 10000, 50822: 30, 50971: 30, 51275: 150,
    51237: 50, 51274: 150, 50824: 200, 50983: 200, 51006: 300, 51300: 1000, 51301: 1000,
}
LAB_OUTPUT = ("aniongap", "albumin", "bands", "bicarbonate", "bilirubin", "creatinine",
              "chloride", "glucose", "hematocrit", "hemoglobin", "lactate", "platelet",
              "potassium", "ptt", "inr", "pt", "sodium", "bun", "wbc")

# Blood-gas items 50800..50828 -> label (50807 and 51545 are
# scanned but unlabelled), and their plausibility upper bounds.
GAS_LABELS = {
    50800: "specimen", 50801: "aado2", 50802: "baseexcess", 50803: "bicarbonate",
    50804: "totalco2", 50805: "carboxyhemoglobin", 50806: "chloride", 50808: "calcium",
    50809: "glucose", 50810: "hematocrit", 50811: "hemoglobin", 50812: "intubated",
    50813: "lactate", 50814: "methemoglobin", 50815: "o2flow", 50816: "fio2",
    50817: "so2", 50818: "pco2", 50819: "peep", 50820: "ph", 50821: "po2",
    50822: "potassium", 50823: "requiredo2", 50824: "sodium", 50825: "temperature",
    50826: "tidalvolume", 50827: "ventilationrate", 50828: "ventilator",
}
GAS_ITEMS = tuple(range(50800, 50829)) + (51545,)
GAS_UPPER = {50810: 100, 50816: 100, 50817: 100, 50815: 70, 50821: 800}
GAS_OUTPUT = ("specimen", "aado2", "baseexcess", "bicarbonate", "totalco2",
              "carboxyhemoglobin", "chloride", "calcium", "glucose", "hematocrit",
              "hemoglobin", "intubated", "lactate", "methemoglobin", "o2flow", "fio2", "so2",
              "pco2", "peep", "ph", "po2", "potassium", "requiredo2", "sodium", "temperature",
              "tidalvolume", "ventilationrate", "ventilator")

# Specimen model (coefficient, mean, intercept) per term, and
# the constant term; p > 0.75 counts as arterial.
SPECIMEN_CONST = -0.02544
SPECIMEN_PO2 = 0.04598
SPECIMEN_TERMS = (
    ("spo2", -0.15356, 97.49420, 0.13429),
    ("fio2_chartevents", 0.00621, 51.49550, -0.24958),
    ("hemoglobin", 0.10559, 10.32307, 0.05954),
    ("so2", 0.13251, 93.66539, -0.23172),
    ("pco2", -0.01511, 42.08866, -0.01630),
    ("fio2", 0.01480, 63.97836, -0.31142),
    ("aado2", -0.00200, 442.21186, -0.01328),
    ("bicarbonate", -0.03220, 22.96894, -0.06535),
    ("totalco2", 0.05384, 24.72632, -0.01405),
    ("lactate", 0.08202, 3.06436, 0.06038),
    ("ph", 0.10956, 7.36233, -0.00617),
    ("o2flow", 0.00848, 7.59362, -0.35803),
)
ARTERIAL_P = 0.75
SPO2_ITEMS = (646, 220277)
FIO2_ITEMS = (3420, 190, 223835, 3422)

# GCS component items (CareVue id, MetaVision id) and defaults.
GCS_VERBAL, GCS_MOTOR, GCS_EYES = (723, 223900), (454, 223901), (184, 220739)
GCS_DEFAULTS = {"motor": 6, "verbal": 5, "eyes": 4}

# Ventilation flags on the first day (14 count towards MechVent).
VENT_FD_ITEMS = {
    "minutevolume": (445, 448, 449, 450, 1340, 1486, 1600, 224687),
    "tv": (639, 654, 681, 682, 683, 684, 224685, 224684, 224686),
    "resppressure": (218, 436, 535, 444, 459, 224697, 224695, 224696, 224746, 224747),
    "insppressure": (221, 1, 1211, 1655, 2000, 226873, 224738, 224419, 224750, 227187),
    "plateaupressure": (543,),
    "aprvpressure": (5865, 5866, 224707, 224709, 224705, 224706),
    "peep": (60, 437, 505, 506, 686, 220339, 224700),
    "highpressurerelease": (3459,),
    "pcv": (501, 502, 503, 224702),
    "tcpcv": (223, 667, 668, 669, 670, 671, 672),
    "ett": (157, 158, 1852, 3398, 3399, 3400, 3401, 3402, 3403, 3404, 8382, 227809, 227810),
    "psvlevel": (224701,),
}

# Height items (inches items converted with 2.54).
HEIGHT_ITEMS = (226730, 920, 1394, 4187, 3486, 3485, 4188)
HEIGHT_INCH_ITEMS = (920, 1394, 4187, 3486)
IN_TO_CM = 2.54
MIN_HEIGHT_CM = 100

# RRT evidence on the first day.
RRT_CV_FLAG_ITEMS = (152, 148, 149, 146, 147, 151, 150)
RRT_CV_LINE_ITEMS = (229, 235, 241, 247, 253, 259, 265, 271)
RRT_CV_VALUES = ("CAVH Start", "CAVH D/C", "CVVHD Start", "CVVHD D/C", "Hemodialysis st",
                 "Hemodialysis end")
RRT_MV_CHART_ITEMS = (
    225126, 226118, 227357, 225725, 226499, 224154, 225810, 227639, 225183, 227438, 224191,
    225806, 225807, 228004, 228005, 228006, 224144, 224145, 224149, 224150, 224151, 224152,
    224153, 224404, 224406, 226457,
)
RRT_MV_INPUT_ITEMS = (227536, 227525)
RRT_MV_DATETIME_ITEMS = (225318, 225319, 225321, 225322, 225324)
RRT_MV_PROCEDURE_ITEMS = (225441, 225802, 225803, 225805, 224270, 225809, 225955, 225436)


def exact_affine(coef: float, mean: float, icept: float) -> float:
    """``coef * mean + icept`` evaluated exactly in decimal, then rounded once."""
    from decimal import Decimal
    return float(Decimal(repr(coef)) * Decimal(repr(mean)) + Decimal(repr(icept)))


def _stays(c: Concepts):
    return c.t.icustays.select("subject_id", "hadm_id", "icustay_id", "intime")


VITALS_SCHEMA = ", ".join(
    f"{n}_{f} double" for n in VITAL_NAMES for f in ("min", "max", "mean"))


@concept("vitals_first_day",
         "subject_id bigint, hadm_id bigint, icustay_id bigint, " + VITALS_SCHEMA)
def vitals_first_day(c: Concepts):
    items = sorted({i for _, ids, _, _ in VITALS for i in ids})
    ce = (c.t.chartevents.where(F.col("itemid").isin(*items) & ~F.col("error").eqNullSafe(1))
          .select("subject_id", "hadm_id", "icustay_id", "itemid", "charttime", "valuenum"))
    j = first_window(ce, _stays(c), 0, 24, key=["subject_id", "hadm_id", "icustay_id"])
    v, item = F.col("valuenum"), F.col("itemid")
    vid = None
    for name, ids, lo, hi in VITALS:
        cond = item.isin(*ids) & (v > lo)
        if hi is not None:
            cond = cond & ((v <= hi) if name == "spo2" else (v < hi))
        vid = F.when(cond, VITAL_IDS[name]) if vid is None else vid.when(cond, VITAL_IDS[name])
    val = F.when(item.isin(*FAHRENHEIT_ITEMS), (v - 32) / 1.8).otherwise(v)
    staged = j.select("subject_id", "hadm_id", "icustay_id", vid.alias("vid"), val.alias("v"))
    aggs = []
    for i, name in enumerate(VITAL_NAMES, start=1):
        x = F.when(F.col("vid") == i, F.col("v"))
        aggs += [F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max"),
                 F.avg(x).alias(f"{name}_mean")]
    return staged.groupBy("subject_id", "hadm_id", "icustay_id").agg(*aggs)


LABS_SCHEMA = ", ".join(f"{n}_{f} double" for n in LAB_OUTPUT for f in ("min", "max"))


def _lab_clean(item, v):
    expr = None
    for k, hi in LAB_UPPER.items():
        cond = (item == k) & (v > hi)
        expr = F.when(cond, None) if expr is None else expr.when(cond, None)
    return expr.when((item == 51144) & (v < 0), None).otherwise(v)


@concept("labs_first_day", "subject_id bigint, hadm_id bigint, icustay_id bigint, " + LABS_SCHEMA)
def labs_first_day(c: Concepts):
    """All stays; labs of the admission in [intime - 6 h, intime + 1 d].

    The reference keeps the window in a left join's ON, so stays without labs
    keep one all-NULL row (N9).  Here the labs are inner-joined and pivoted
    first -- the big side streams, so AQE can split a skewed admission -- and
    the (small) per-stay result is then left-joined onto all stays: same rows.
    """
    ie = _stays(c)
    le = (c.t.labevents.where(F.col("itemid").isin(*LAB_LABELS)
                              & F.col("valuenum").isNotNull() & (F.col("valuenum") > 0))
          .select("subject_id", "hadm_id", "itemid", "charttime", "valuenum"))
    j = (le.join(ie, ["subject_id", "hadm_id"])
         .where(in_window(F.col("charttime"), F.col("intime"), 6, 24)))
    item, v = F.col("itemid"), F.col("valuenum")
    staged = j.select("icustay_id", case_map(item, LAB_LABELS).alias("label"),
                      _lab_clean(item, v).alias("v"))
    pivot = staged.groupBy("icustay_id").agg(
        *pivot_aggs(F.col("label"), F.col("v"), LAB_OUTPUT, ("min", "max")))
    return ie.drop("intime").join(pivot, "icustay_id", "left")


GAS_SCHEMA = ", ".join(f"{n} {'string' if n == 'specimen' else 'double'}" for n in GAS_OUTPUT)


def _gas_clean(item, v):
    expr = F.when(v <= 0, None)
    for k, hi in GAS_UPPER.items():
        expr = expr.when((item == k) & (v > hi), None)
    return expr.otherwise(v)


@concept("blood_gas_pivot", "subject_id bigint, hadm_id bigint, icustay_id bigint, "
                            "charttime timestamp_ntz, " + GAS_SCHEMA)
def blood_gas_pivot(c: Concepts):
    """Gas values pivoted per (stay, charttime); a stay without gases keeps one
    row with NULL time (the reference's left join).  As for the labs, the
    pivot runs on the inner join and the stays are left-joined afterwards."""
    ie = _stays(c)
    le = (c.t.labevents.where(F.col("itemid").isin(*GAS_ITEMS))
          .select("subject_id", "hadm_id", "itemid", "charttime", "value", "valuenum"))
    j = (le.join(ie, ["subject_id", "hadm_id"])
         .where(in_window(F.col("charttime"), F.col("intime"), 6, 24)))
    item = F.col("itemid")
    staged = j.select("icustay_id", "charttime", case_map(item, GAS_LABELS).alias("label"),
                      "value", _gas_clean(item, F.col("valuenum")).alias("v"))
    lab = F.col("label")
    aggs = [F.max(F.when(lab == "specimen", F.col("value"))).alias("specimen")]
    aggs += [F.max(F.when(lab == n, F.col("v"))).alias(n) for n in GAS_OUTPUT[1:]]
    pivot = staged.groupBy("icustay_id", "charttime").agg(*aggs)
    return ie.drop("intime").join(pivot, "icustay_id", "left")


def _near_gases(rows, gases, lookback_hours: int):
    """Charted rows that can matter to a gas: of stays with one, no older than the look-back."""
    span = (gases.groupBy("icustay_id")
            .agg((F.min("charttime") - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))).alias("_from"),
                 F.max("charttime").alias("_to")))
    return (rows.where(F.col("icustay_id").isNotNull()).join(span, "icustay_id")
            .where(F.col("charttime").between(F.col("_from"), F.col("_to"))).drop("_from", "_to"))


def _spo2_rows(c: Concepts, gases):
    v = F.col("valuenum")
    rows = c.t.chartevents.where(F.col("itemid").isin(*SPO2_ITEMS)).select(
        "subject_id", "hadm_id", "icustay_id", "charttime", "valuenum")
    return (_near_gases(rows, gases, 2)
            .groupBy("subject_id", "hadm_id", "icustay_id", "charttime")
            .agg(F.max(F.when((v <= 0) | (v > 100), None).otherwise(v)).alias("spo2")))


def _fio2_rows(c: Concepts, gases):
    v, item = F.col("valuenum"), F.col("itemid")
    fio2 = (
        F.when(item == 223835,
               F.when((v > 0) & (v <= 1), v * 100)
               .when((v > 1) & (v < 21), None)
               .when((v >= 21) & (v <= 100), v))
        .when(item.isin(3420, 3422), v)
        .when((item == 190) & (v > 0.20) & (v < 1), v * 100)
    )
    rows = (c.t.chartevents.where(item.isin(*FIO2_ITEMS) & ~F.col("error").eqNullSafe(1))
            .select("subject_id", "hadm_id", "icustay_id", "charttime", "itemid", "valuenum"))
    return (_near_gases(rows, gases, 4)
            .groupBy("subject_id", "hadm_id", "icustay_id", "charttime")
            .agg(F.max(fio2).alias("fio2_chartevents")))


ASOF_SPO2_SCHEMA = ("subject_id bigint, hadm_id bigint, icustay_id bigint, "
                    "charttime timestamp_ntz, " + GAS_SCHEMA + ", spo2 double")


@concept("asof_spo2", ASOF_SPO2_SCHEMA)
def asof_spo2(c: Concepts):
    """Gas rows with a PO2 and the latest SpO2 row within 2 h before."""
    bg = c.get("blood_gas_pivot").where(F.col("po2").isNotNull())
    return asof_last(bg, _spo2_rows(c, bg), "icustay_id", 2, ["spo2"]).drop("_asof_time")


@concept("asof_fio2", ASOF_SPO2_SCHEMA + ", fio2_chartevents double, specimen_prob double")
def asof_fio2(c: Concepts):
    """Then the latest charted FiO2 within 4 h, and the specimen probability."""
    left = c.get("asof_spo2")
    df = asof_last(left, _fio2_rows(c, left), "icustay_id", 4,
                   ["fio2_chartevents"]).drop("_asof_time")
    z = F.lit(SPECIMEN_CONST) + F.lit(SPECIMEN_PO2) * F.col("po2")
    for col, coef, mean, icept in SPECIMEN_TERMS:
        z = z + F.coalesce(F.lit(coef) * F.col(col), F.lit(exact_affine(coef, mean, icept)))
    return df.withColumn("specimen_prob", 1 / (1 + F.exp(-z)))


ARTERIAL_SCHEMA = """
    subject_id bigint, hadm_id bigint, icustay_id bigint, charttime timestamp_ntz,
    specimen string, specimen_pred string, specimen_prob double, so2 double, spo2 double,
    po2 double, pco2 double, fio2_chartevents double, fio2 double, aado2 double,
    aado2_calc double, pao2fio2 double, ph double, baseexcess double, bicarbonate double,
    totalco2 double, hematocrit double, hemoglobin double, carboxyhemoglobin double,
    methemoglobin double, chloride double, calcium double, temperature double,
    potassium double, sodium double, lactate double, glucose double, intubated double,
    tidalvolume double, ventilationrate double, ventilator double, peep double,
    o2flow double, requiredo2 double"""


@concept("blood_gas_arterial", ARTERIAL_SCHEMA)
def blood_gas_arterial(c: Concepts):
    df = c.get("asof_fio2").where((F.col("specimen") == "ART")
                                  | (F.col("specimen_prob") > ARTERIAL_P))
    fio2 = F.coalesce(F.col("fio2"), F.col("fio2_chartevents"))
    po2, pco2 = F.col("po2"), F.col("pco2")
    return df.select(
        "*",
        F.when(F.col("specimen").isNotNull(), F.col("specimen"))
        .when(F.col("specimen_prob") > ARTERIAL_P, "ART").alias("specimen_pred"),
        F.when(po2.isNotNull() & pco2.isNotNull() & fio2.isNotNull(),
               (fio2 / 100) * (760 - 47) - (pco2 / 0.8) - po2).alias("aado2_calc"),
        F.when(po2.isNotNull() & fio2.isNotNull(), 100 * po2 / fio2).alias("pao2fio2"),
    )


@concept("gcs_min", """
    subject_id bigint, hadm_id bigint, icustay_id bigint, mingcs double, gcsmotor double,
    gcsverbal double, gcseyes double, endotrachflag int""")
def gcs_min(c: Concepts):
    """Lowest GCS of the first day (J15 as lag, W10, A12)."""
    item, value = F.col("itemid"), F.col("value")
    ce = (c.t.chartevents
          .where(item.isin(*(GCS_VERBAL + GCS_MOTOR + GCS_EYES))
                 & ~F.col("error").eqNullSafe(1))
          .select("icustay_id", "charttime", "itemid", "value", "valuenum"))
    j = first_window(ce, _stays(c), 0, 24)
    merged = case_map(item, {GCS_VERBAL: 723, GCS_MOTOR: 454, GCS_EYES: 184})
    v = (F.when((item == 723) & (value == "1.0 ET/Trach"), 0)
         .when((item == 223900) & (value == "No Response-ETT"), 0)
         .otherwise(F.col("valuenum")))
    pv = j.select("icustay_id", "charttime", merged.alias("item"), v.alias("v"))
    base = pv.groupBy("icustay_id", "charttime").agg(
        F.max(F.when(F.col("item") == 454, F.col("v"))).alias("gcsmotor"),
        F.max(F.when(F.col("item") == 723, F.col("v"))).alias("gcsverbal"),
        F.max(F.when(F.col("item") == 184, F.col("v"))).alias("gcseyes"))
    base = base.withColumn("endotrachflag", F.when(F.col("gcsverbal") == 0, 1).otherwise(0))
    comps = ["gcsverbal", "gcsmotor", "gcseyes"]
    nb = neighbours(base, ["icustay_id"], ["charttime"], ["charttime", *comps], prev=1, keep=c.keep("gcs_rows"))
    near = micros_between(F.col("prev1_charttime"), F.col("charttime")) < 6 * US_PER_HOUR
    withprev = nb.select(*base.columns,
                         *[F.when(near, F.col(f"prev1_{k}")).alias(f"{k}prev") for k in comps])
    b = {k: F.col(f"gcs{k}") for k in ("motor", "verbal", "eyes")}
    p = {k: F.col(f"gcs{k}prev") for k in ("motor", "verbal", "eyes")}
    d = GCS_DEFAULTS
    gcs = (
        F.when(b["verbal"] == 0, 15)
        .when(b["verbal"].isNull() & (p["verbal"] == 0), 15)
        .when(p["verbal"] == 0,
              F.coalesce(b["motor"], F.lit(d["motor"])) + F.coalesce(b["verbal"], F.lit(d["verbal"]))
              + F.coalesce(b["eyes"], F.lit(d["eyes"])))
        .otherwise(
            F.coalesce(b["motor"], p["motor"], F.lit(d["motor"]))
            + F.coalesce(b["verbal"], p["verbal"], F.lit(d["verbal"]))
            + F.coalesce(b["eyes"], p["eyes"], F.lit(d["eyes"])))
    )
    # lowest GCS row per stay (ties: earliest) as one aggregate, not a window
    pick = F.min(F.struct(
        F.col("gcs").alias("mingcs"), F.col("charttime"),
        F.coalesce(b["motor"], p["motor"]).alias("gcsmotor"),
        F.coalesce(b["verbal"], p["verbal"]).alias("gcsverbal"),
        F.coalesce(b["eyes"], p["eyes"]).alias("gcseyes"), F.col("endotrachflag")))
    best = (withprev.withColumn("gcs", gcs).groupBy("icustay_id").agg(pick.alias("_b"))
            .select("icustay_id", "_b.mingcs", "_b.gcsmotor", "_b.gcsverbal", "_b.gcseyes",
                    "_b.endotrachflag"))
    return (c.t.icustays.select("subject_id", "hadm_id", "icustay_id")
            .join(best, "icustay_id", "left"))


@concept("urine_first_day", "subject_id bigint, hadm_id bigint, icustay_id bigint, "
                            "urineoutput double")
def urine_first_day(c: Concepts):
    oe = (c.t.outputevents.where(F.col("itemid").isin(*URINE_ITEMS))
          .select("subject_id", "hadm_id", "icustay_id", "itemid", "charttime", "value"))
    s = _stays(c)
    j = (oe.join(s, ["subject_id", "hadm_id", "icustay_id"])
         .where(in_window(F.col("charttime"), F.col("intime"), 0, 24)))
    u = F.when(F.col("itemid") == IRRIGANT_OUT, -1 * F.col("value")).otherwise(F.col("value"))
    return j.groupBy("subject_id", "hadm_id", "icustay_id").agg(F.sum(u).alias("urineoutput"))


@concept("vent_first_day", "subject_id bigint, hadm_id bigint, icustay_id bigint, mechvent int")
def vent_first_day(c: Concepts):
    """1 if any of the 14 ventilation settings is charted on the first day."""
    item, value = F.col("itemid"), F.col("value")
    any_items = sorted({i for ids in VENT_FD_ITEMS.values() for i in ids})
    vented = ((item.isin(*any_items)) | ((item == 720) & (value != "Other/Remarks"))
              | ((item == 467) & (value == "Ventilator")))
    ce = (c.t.chartevents.where(value.isNotNull() & ~F.col("error").eqNullSafe(1))
          .select("icustay_id", "charttime", "itemid", "value"))
    j = first_window(ce, _stays(c), 0, 24).where(vented)
    flagged = j.select("icustay_id").distinct().withColumn("_v", F.lit(1))
    return (c.t.icustays.select("subject_id", "hadm_id", "icustay_id")
            .join(flagged, "icustay_id", "left")
            .select("subject_id", "hadm_id", "icustay_id",
                    F.coalesce(F.col("_v"), F.lit(0)).alias("mechvent")))


def _adult_stays(c: Concepts):
    pat = c.t.patients.select("subject_id", "dob")
    return (c.t.icustays.join(pat, "subject_id")
            .where(F.col("intime") > F.col("dob") + F.expr("INTERVAL 1 YEAR")))


@concept("height_first_day", "icustay_id bigint, height double, height_chart double, "
                             "height_echo double")
def height_first_day(c: Concepts):
    item, v = F.col("itemid"), F.col("valuenum")
    ce = (c.t.chartevents.where(item.isin(*HEIGHT_ITEMS) & v.isNotNull() & (v != 0)
                                & ~F.col("error").eqNullSafe(1))
          .select("icustay_id", "itemid", "charttime", "valuenum"))
    j = first_window(ce, c.t.icustays, 24, 24, lower_open=True)
    h = F.when(item.isin(*HEIGHT_INCH_ITEMS), v * IN_TO_CM).otherwise(v)
    charted = j.select(F.lit("chart").alias("source"), F.col("icustay_id").alias("id"), h.alias("h")) \
        .where(F.col("h") > MIN_HEIGHT_CM)
    echo = c.get("echo_data").where(F.col("height").isNotNull()
                                    & (F.col("height") * IN_TO_CM > MIN_HEIGHT_CM))
    ie = c.t.icustays.select("subject_id", "intime")
    echoed = (echo.select("subject_id", "charttime", "height").join(ie, "subject_id")
              .where(F.col("charttime") < plus_days(F.col("intime"), 1))
              .select(F.lit("echo").alias("source"), F.col("subject_id").alias("id"), F.col("height").alias("h")))
    found = medians(charted.unionByName(echoed), ["source", "id"], "h", keep=c.keep("height_values"))
    chart = found.where(F.col("source") == "chart").select(F.col("id").alias("icustay_id"),
                                                           F.col("median").alias("height_chart"))
    echo_h = found.where(F.col("source") == "echo").select(
        F.col("id").alias("subject_id"), (F.lit(IN_TO_CM) * F.col("median")).alias("height_echo"))
    adults = _adult_stays(c).select("icustay_id", "subject_id")
    return (adults.join(chart, "icustay_id", "left").join(echo_h, "subject_id", "left")
            .select("icustay_id", F.coalesce("height_chart", "height_echo").alias("height"),
                    "height_chart", "height_echo"))


@concept("weight_first_day_all", """
    icustay_id bigint, weight double, weight_admit double, weight_daily double,
    weight_echoinhosp double, weight_echoprehosp double""")
def weight_first_day_all(c: Concepts):
    return weight_first_day_for(c, _adult_stays(c).select("subject_id", "icustay_id"))


@concept("rrt_first_day", "subject_id bigint, hadm_id bigint, icustay_id bigint, rrt int")
def rrt_first_day(c: Concepts):
    """Any RRT evidence in the first day from five sources."""
    s = c.t.icustays.select("icustay_id", "intime", "dbsource")
    item, value, v = F.col("itemid"), F.col("value"), F.col("valuenum")
    ce = c.t.chartevents.select("icustay_id", "itemid", "charttime", "value", "valuenum")
    cv = (first_window(ce.where(value.isNotNull() & item.isin(
        *(RRT_CV_FLAG_ITEMS + RRT_CV_LINE_ITEMS + (582,)))), s, 0, 24, stay_cols=("dbsource",))
        .where(F.col("dbsource") == "carevue")
        .where((item.isin(*RRT_CV_FLAG_ITEMS) & value.isNotNull())
               | (item.isin(*RRT_CV_LINE_ITEMS) & (value == "Dialysis Line"))
               | ((item == 582) & value.isin(*RRT_CV_VALUES)))
        .select("icustay_id"))
    mv_ce = (first_window(ce.where(item.isin(*RRT_MV_CHART_ITEMS) & (v > 0)), s, 0, 24)
             .select("icustay_id"))
    ie_mv = c.t.inputevents_mv.where(item.isin(*RRT_MV_INPUT_ITEMS) & (F.col("amount") > 0))
    mv_ie = first_window(ie_mv, s, 0, 24, time_col="starttime").select("icustay_id")
    de = c.t.datetimeevents.where(item.isin(*RRT_MV_DATETIME_ITEMS))
    mv_de = first_window(de, s, 0, 24).select("icustay_id")
    pe = c.t.procedureevents_mv.where(item.isin(*RRT_MV_PROCEDURE_ITEMS))
    mv_pe = first_window(pe, s, 0, 24, time_col="starttime").select("icustay_id")
    any_rrt = (cv.unionByName(mv_ce).unionByName(mv_ie).unionByName(mv_de)
               .unionByName(mv_pe).distinct().withColumn("_r", F.lit(1)))
    return (c.t.icustays.select("subject_id", "hadm_id", "icustay_id")
            .join(any_rrt, "icustay_id", "left")
            .select("subject_id", "hadm_id", "icustay_id",
                    F.coalesce(F.col("_r"), F.lit(0)).alias("rrt")))
