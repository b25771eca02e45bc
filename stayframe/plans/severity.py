"""Severity scores on the first ICU day (C37-C40) and their attachment."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayframe.functions.numeric import numeric_round
from stayframe.functions.rules import rule_column
from stayframe.functions.scoring import bands, logistic, sum_scores, worst_of
from stayframe.plans import score_rules as rules
from stayframe.functions.timeops import micros_between, US_PER_HOUR
from stayframe.operators.intervals import in_intervals
from stayframe.operators.ranking import ranks
from stayframe.operators.windows import first_window
from stayframe.plans.base import Concepts, concept

# ---------------------------------------------------------------------------
# Weight items for vasopressor dosing, unit factors, drug items.
# ---------------------------------------------------------------------------
KG_WEIGHT_ITEMS = (762, 763, 3723, 3580, 226512)
LB_WEIGHT_ITEM, OZ_WEIGHT_ITEM = 3581, 3582
LB_TO_KG_EXACT = 0.45359237
OZ_TO_KG = 0.0283495231
VASO_CV_ITEMS = (30047, 30120, 30044, 30119, 30309, 30043, 30307, 30042, 30306)
VASO_MV_ITEMS = (221906, 221289, 221662, 221653)
CPAP_ITEMS = (467, 469, 226732)
CPAP_PATTERN = "(cpap mask|bipap mask)"
CKD_CODES = ("5854", "5855", "5856")

# ICD-9 ranges of SAPS II comorbidities, on 5-character codes.
AIDS_RANGES = (("042  ", "0449 "),)
HEM_RANGES = (("20000", "20238"), ("20240", "20248"), ("20250", "20302"), ("20310", "20312"),
              ("20302", "20382"), ("20400", "20522"), ("20580", "20702"), ("20720", "20892"))
HEM_CODES = ("2386 ", "2733 ")
METS_RANGES = (("1960 ", "1991 "), ("20970", "20975"))
METS_CODES = ("20979", "78951")

# APS III bands (edges -> points) and normal values for worst-of.
APS_BANDS = {
    "heartrate": ((40, 50, 100, 110, 120, 140, 155), (8, 5, 0, 1, 5, 7, 13, 17)),
    "meanbp": ((40, 60, 70, 80, 100, 120, 130, 140), (23, 15, 7, 6, 0, 4, 7, 9, 10)),
    "tempc": ((33.0, 33.5, 34.0, 35.0, 36.0, 40.0), (20, 16, 13, 8, 2, 0, 4)),
    "resprate": ((6, 12, 14, 25, 35, 40, 50), (17, 8, 7, 0, 6, 9, 11, 18)),
    "hematocrit": ((41.0, 50.0), (3, 0, 3)),
    "wbc": ((1.0, 3.0, 20.0, 25.0), (19, 5, 0, 1, 5)),
    "creatinine": ((0.5, 1.5, 1.95), (3, 0, 4, 7)),
    "bun": ((17.0, 20.0, 40.0, 80.0), (0, 2, 7, 11, 12)),
    "sodium": ((120, 135, 155), (3, 2, 0, 4)),
    "albumin": ((2.0, 2.5, 4.5), (11, 6, 0, 4)),
    "bilirubin": ((2.0, 3.0, 5.0, 8.0), (0, 5, 6, 8, 16)),
    "glucose": ((40, 60, 200, 350), (8, 9, 0, 3, 5)),
}
APS_NORMALS = {"heartrate": 75, "meanbp": 90, "tempc": 38, "resprate": 19, "hematocrit": 45.5,
               "wbc": 11.5, "sodium": 145.5, "albumin": 3.5, "glucose": 130}
APS_URINE = ((400, 600, 900, 1500, 2000, 4000), (15, 8, 7, 5, 4, 0, 1))
APS_PROB = (-4.4360, 0.04726)
SAPS_PROB = (-7.7631, 0.0737, 0.9971)


def _ie(c: Concepts):
    return c.t.icustays.select("subject_id", "hadm_id", "icustay_id", "intime")


def _gas_on_vent(c: Concepts):
    """Arterial gases left-joined to ventilation episodes containing them."""
    found = in_intervals(c.get("blood_gas_arterial"), c.get("vent_durations"), ["icustay_id"], matched="_on")
    return found.withColumn("isvent", F.col("_on").cast("int")).drop("_on")


@concept("gas_on_vent", """
    icustay_id bigint, charttime timestamp_ntz, pao2fio2 double, isvent int""")
def gas_on_vent(c: Concepts):
    return _gas_on_vent(c)


def _weights_for_dosing(c: Concepts):
    item, v = F.col("itemid"), F.col("valuenum")
    ce = c.t.chartevents.where(
        v.isNotNull() & item.isin(*(KG_WEIGHT_ITEMS + (LB_WEIGHT_ITEM, OZ_WEIGHT_ITEM)))
        & (v != 0) & ~F.col("error").eqNullSafe(1)).select("icustay_id", "itemid", "charttime",
                                                           "valuenum")
    kg = (F.when(item.isin(*KG_WEIGHT_ITEMS), v)
          .when(item == LB_WEIGHT_ITEM, v * LB_TO_KG_EXACT)
          .when(item == OZ_WEIGHT_ITEM, v * OZ_TO_KG))
    wt = (first_window(ce, c.t.icustays, 24, 24).groupBy("icustay_id")
          .agg(F.avg(kg).alias("wt_weight")))
    ie = c.t.icustays.select("icustay_id", "hadm_id", "intime").alias("ie")
    echo = c.get("echo_data").select("hadm_id", "charttime", "weight").alias("ec")
    d = micros_between(F.col("ie.intime"), F.col("ec.charttime"))
    on = ((F.col("ie.hadm_id") == F.col("ec.hadm_id"))
          & (d > -7 * 24 * US_PER_HOUR) & (d < 24 * US_PER_HOUR))
    echo2 = (ie.join(echo, on, "left").groupBy("ie.icustay_id")
             .agg(F.avg(F.col("ec.weight") * LB_TO_KG_EXACT).alias("ec_weight")))
    return wt, echo2


def _vaso_rates(c: Concepts):
    item, rate = F.col("itemid"), F.col("rate")
    wt, echo2 = _weights_for_dosing(c)
    cv = c.t.inputevents_cv.where(item.isin(*VASO_CV_ITEMS) & rate.isNotNull()) \
        .select("icustay_id", "itemid", "charttime", "rate")
    cvj = (first_window(cv, c.t.icustays, 0, 24)
           .join(wt, "icustay_id", "left").join(echo2, "icustay_id", "left"))
    w = F.coalesce(F.col("wt_weight"), F.col("ec_weight"))
    vaso_cv = cvj.groupBy("icustay_id").agg(
        F.max(F.when(item == 30047, F.try_divide(rate, w)).when(item == 30120, rate))
        .alias("cv_norepi"),
        F.max(F.when(item == 30044, F.try_divide(rate, w)).when(item.isin(30119, 30309), rate))
        .alias("cv_epi"),
        F.max(F.when(item.isin(30043, 30307), rate)).alias("cv_dopa"),
        F.max(F.when(item.isin(30042, 30306), rate)).alias("cv_dobu"))
    mv = (c.t.inputevents_mv.where(item.isin(*VASO_MV_ITEMS)
                                   & (F.col("statusdescription") != "Rewritten"))
          .select("icustay_id", "itemid", "starttime", "rate"))
    vaso_mv = first_window(mv, c.t.icustays, 0, 24, time_col="starttime").groupBy(
        "icustay_id").agg(
        F.max(F.when(item == 221906, rate)).alias("mv_norepi"),
        F.max(F.when(item == 221289, rate)).alias("mv_epi"),
        F.max(F.when(item == 221662, rate)).alias("mv_dopa"),
        F.max(F.when(item == 221653, rate)).alias("mv_dobu"))
    return vaso_cv, vaso_mv


@concept("stay_admission")
def stay_admission(c: Concepts):
    """A row per stay with what hangs on its admission and patient: the joins on those
    keys are done once for all scores.  ``admitted``: both are known."""
    sf = c.get("service_flag").where(F.col("serviceorder") == 1).select("hadm_id", "surgical")
    adm = c.t.admissions.select("hadm_id", "admission_type", F.lit(True).alias("_adm"))
    pat = c.t.patients.select("subject_id", "dob", F.lit(True).alias("_pat"))
    ckd = c.t.diagnoses_icd.groupBy("hadm_id").agg(
        F.max(F.when(F.col("icd9_code").isin(*CKD_CODES), 1).otherwise(0)).alias("ckd"))
    by_admission = (adm.join(sf, "hadm_id", "left").join(c.get("comorbidity_flags"), "hadm_id", "left")
                    .join(ckd, "hadm_id", "left"))
    return (_ie(c).join(by_admission, "hadm_id", "left").join(pat, "subject_id", "left")
            .withColumn("admitted", F.col("_adm").isNotNull() & F.col("_pat").isNotNull())
            .drop("_adm", "_pat"))


@concept("stay_features")
def stay_features(c: Concepts):
    """A row per stay with the first-day inputs that several scores take from gases and
    vasopressors; a stay without any has no row."""
    col = F.col
    # only rank 1 counts: the first gas in each order, as map-side combined minima
    # (NULL AaDO2 sorts first; a first gas that does not qualify gives nothing)
    fio2, vent = F.coalesce("fio2", "fio2_chartevents"), col("isvent") == 1
    first = c.get("gas_on_vent").groupBy("icustay_id").agg(
        F.min(F.when(col("isvent") == 0, col("pao2fio2"))).alias("pf_novent"),
        F.min(F.when(vent, col("pao2fio2"))).alias("pf_vent"),
        F.min(F.struct((-col("po2")).alias("k"), "charttime", "isvent", "po2",
                       (~vent & ~F.coalesce(fio2 >= 0.5, F.lit(False))).alias("ok"))).alias("p"),
        F.min(F.struct(col("aado2").isNotNull().alias("n"), (-col("aado2")).alias("k"), "charttime", "isvent",
                       "aado2", (vent & F.coalesce(fio2 >= 0.5, F.lit(False))).alias("ok"))).alias("a"))
    gases = first.select("icustay_id", "pf_novent", "pf_vent",
                         F.when(col("p.ok"), col("p.po2")).alias("pao2"),
                         F.when(col("a.ok"), col("a.aado2")).alias("aado2"))
    on_device = in_intervals(c.get("gas_on_vent"), c.get("device_flag"), ["icustay_id"], width_hours=6)
    support = (on_device.where((col("isvent") == 1) | col("matched"))
               .groupBy("icustay_id").agg(F.min("pao2fio2").alias("pf_support")))
    # the worst (row-number-1 by score DESC) acid-base score is the max score:
    # every row here has pH and PaCO2, so the score is never NULL
    art = c.get("blood_gas_arterial")
    acidbase = (art.where(col("ph").isNotNull() & col("pco2").isNotNull())
                .select("icustay_id", rule_column(*rules.APS_ACIDBASE).alias("s"))
                .groupBy("icustay_id").agg(F.max("s").alias("acidbase_score")))
    arterial = (art.where(col("specimen_pred") == "ART")
                .groupBy("icustay_id").agg(F.min("pco2").alias("paco2_min")))
    return c.stay_row(gases, support, acidbase, arterial, *_vaso_rates(c))


SOFA_SCHEMA = """
    subject_id bigint, hadm_id bigint, icustay_id bigint, sofa int, respiration int,
    coagulation int, liver int, cardiovascular int, cns int, renal int"""


@concept("sofa", SOFA_SCHEMA)
def sofa(c: Concepts):
    v = c.get("vitals_first_day").select("icustay_id", "meanbp_min")
    lab = c.get("labs_first_day").select("icustay_id", "creatinine_max", "bilirubin_max",
                                        "platelet_min")
    uo = c.get("urine_first_day").select("icustay_id", "urineoutput")
    gcs = c.get("gcs_min").select("icustay_id", "mingcs")
    comp = c.stay_join(c.get("stay_admission").select("subject_id", "hadm_id", "icustay_id"),
                       c.get("stay_features"), v, lab, uo, gcs)
    inputs = comp.select(
        "subject_id", "hadm_id", "icustay_id", "meanbp_min", "creatinine_max",
        "bilirubin_max", "platelet_min", "urineoutput", "mingcs",
        F.col("pf_vent").alias("pao2fio2_vent_min"), F.col("pf_novent").alias("pao2fio2_novent_min"),
        F.coalesce("cv_norepi", "mv_norepi").alias("rate_norepinephrine"),
        F.coalesce("cv_epi", "mv_epi").alias("rate_epinephrine"),
        F.coalesce("cv_dopa", "mv_dopa").alias("rate_dopamine"),
        F.coalesce("cv_dobu", "mv_dobu").alias("rate_dobutamine"))
    parts = inputs.select("subject_id", "hadm_id", "icustay_id",
                          *[rule_column(*rules.SOFA[n]).alias(n) for n in rules.SOFA])
    names = ["respiration", "coagulation", "liver", "cardiovascular", "cns", "renal"]
    return parts.select("subject_id", "hadm_id", "icustay_id",
                        sum_scores(*[F.col(n) for n in names]).alias("sofa"), *names)


@concept("device_flag", "icustay_id bigint, starttime timestamp_ntz, endtime timestamp_ntz, "
                        "cpap int")
def device_flag(c: Concepts):
    """CPAP/BiPAP mask charted on the first day, widened by -1 h / +4 h."""
    low = F.lower(F.col("value"))
    ce = (c.t.chartevents.where(F.col("itemid").isin(*CPAP_ITEMS) & low.rlike(CPAP_PATTERN)
                                & ~F.col("error").eqNullSafe(1))
          .select("icustay_id", "charttime", "value"))
    j = first_window(ce, c.t.icustays, 0, 24)
    return j.groupBy("icustay_id").agg(
        (F.min("charttime") - F.expr("INTERVAL 1 HOUR")).alias("starttime"),
        (F.max("charttime") + F.expr("INTERVAL 4 HOURS")).alias("endtime"),
        F.max(F.when(F.lower(F.col("value")).rlike(CPAP_PATTERN), 1).otherwise(0)).alias("cpap"))


@concept("service_flag", "hadm_id bigint, surgical int, serviceorder int")
def service_flag(c: Concepts):
    """Surgical flag of each admission's first service (J18 keeps serviceorder = 1)."""
    adm = c.t.admissions.select("hadm_id")
    j = adm.join(c.t.services, "hadm_id", "left")
    w = Window.partitionBy("hadm_id").orderBy(F.col("transfertime").asc_nulls_last(),
                                              "curr_service")
    return j.select("hadm_id",
                    F.when(F.lower(F.col("curr_service")).like("%surg%"), 1).otherwise(0)
                    .alias("surgical"),
                    F.row_number().over(w).alias("serviceorder"))


def _code5(col):
    return F.rpad(col, 5, " ")


@concept("comorbidity_flags", "hadm_id bigint, aids int, hem int, mets int")
def comorbidity_flags(c: Concepts):
    """SAPS II comorbidities from char(5) ICD-9 ranges (A6: 1 or NULL)."""
    code = _code5(F.col("icd9_code"))

    def any_of(ranges, codes=()):
        cond = None
        for lo, hi in ranges:
            x = code.between(lo, hi)
            cond = x if cond is None else cond | x
        for cd in codes:
            cond = cond | (code == cd)
        return F.max(F.when(cond, 1))

    return c.t.diagnoses_icd.groupBy("hadm_id").agg(
        any_of(AIDS_RANGES).alias("aids"),
        any_of(HEM_RANGES, HEM_CODES).alias("hem"),
        any_of(METS_RANGES, METS_CODES).alias("mets"))


SAPS_PARTS = ("age_score", "hr_score", "sysbp_score", "temp_score", "pao2fio2_score",
              "uo_score", "bun_score", "wbc_score", "potassium_score", "sodium_score",
              "bicarbonate_score", "bilirubin_score", "gcs_score", "comorbidity_score",
              "admissiontype_score")


@concept("sapsii", "subject_id bigint, hadm_id bigint, icustay_id bigint, sapsii int, "
                   "sapsii_prob double, " + ", ".join(f"{p} int" for p in SAPS_PARTS))
def sapsii(c: Concepts):
    pafi = c.get("stay_features").select("icustay_id", F.col("pf_support").alias("pao2fio2_vent_min"))
    vit = c.get("vitals_first_day").select("icustay_id", "heartrate_max", "heartrate_min",
                                          "sysbp_max", "sysbp_min", "tempc_max", "tempc_min")
    lab = c.get("labs_first_day").select(
        "icustay_id", *[f"{n}_{m}" for n in ("bun", "wbc", "potassium", "sodium", "bicarbonate",
                                             "bilirubin") for m in ("min", "max")])
    co = c.stay_join(c.get("stay_admission"), pafi, c.get("gcs_min").select("icustay_id", "mingcs"),
                     vit, c.get("urine_first_day").select("icustay_id", "urineoutput"), lab)
    col = F.col
    days = F.datediff(col("intime").cast("date"), col("dob").cast("date")).cast("double")
    age = numeric_round(days / 365.242, 2)
    adm_kind = (F.when((col("admission_type") == "ELECTIVE") & (col("surgical") == 1),
                       "ScheduledSurgical")
                .when((col("admission_type") != "ELECTIVE") & (col("surgical") == 1),
                      "UnscheduledSurgical")
                .otherwise("Medical"))
    staged = co.withColumn("age", age).withColumn("admissiontype", adm_kind)
    # a stay without a known admission and patient has no score
    known = F.col("admitted")
    comp = staged.select("subject_id", "hadm_id", "icustay_id", "admitted", *[
        F.when(known, rule_column(*rules.SAPSII[n])).alias(n) for n in SAPS_PARTS])
    scored = comp.withColumn("sapsii", F.when(known, sum_scores(*[F.col(p) for p in SAPS_PARTS])))
    a, b, k = SAPS_PROB
    prob = logistic(F.lit(a) + F.lit(b) * F.col("sapsii") + F.lit(k) * F.ln(F.col("sapsii") + 1))
    return scored.select("subject_id", "hadm_id", "icustay_id", "sapsii",
                         prob.alias("sapsii_prob"), *SAPS_PARTS)


@concept("aps_gas_pick", """
    icustay_id bigint, charttime timestamp_ntz, pao2 double, aado2 double, isvent int,
    aado2_rn int, pao2_rn int""")
def aps_gas_pick(c: Concepts):
    """Row numbers over *all* gas rows, then masked (W3: never pre-filter).

    PG sorts DESC with NULLS FIRST (N4); charttime then the vent flag break
    ties so the pick is deterministic.
    """
    bg = c.get("gas_on_vent")
    fio2 = F.coalesce(F.col("fio2"), F.col("fio2_chartevents"))
    vent = F.col("isvent") == 1
    by_aado2 = ["icustay_id", F.col("aado2").desc_nulls_first(), "charttime", "isvent"]
    by_po2 = ["icustay_id", F.col("po2").desc_nulls_first(), "charttime", "isvent"]
    bg = bg.select("icustay_id", "charttime", "po2", "aado2", "isvent", fio2.alias("_fio2"))
    bg = ranks(bg, by_aado2, {"_aa": (["icustay_id"], None)}, keep=c.keep("gases_by_aado2"))
    bg = ranks(bg, by_po2, {"_pa": (["icustay_id"], None)}, keep=c.keep("gases_by_po2"))
    high = F.col("_fio2") >= 0.5
    return bg.select(
        "icustay_id", "charttime", F.col("po2").alias("pao2"), "aado2", "isvent",
        F.when(vent & high, F.col("_aa")).alias("aado2_rn"),
        F.when(high, None).when(vent, None).otherwise(F.col("_pa")).alias("pao2_rn"))


APS_PARTS = ("hr_score", "meanbp_score", "temp_score", "resprate_score", "pao2_aado2_score",
             "hematocrit_score", "wbc_score", "creatinine_score", "uo_score", "bun_score",
             "sodium_score", "albumin_score", "bilirubin_score", "glucose_score",
             "acidbase_score", "gcs_score")


@concept("apsiii", "subject_id bigint, hadm_id bigint, icustay_id bigint, apsiii int, "
                   "apsiii_prob double, " + ", ".join(f"{p} int" for p in APS_PARTS))
def apsiii(c: Concepts):
    col = F.col
    uo = c.get("urine_first_day").select("icustay_id", "urineoutput")
    labs = c.get("labs_first_day")
    vit = c.get("vitals_first_day").select(
        "icustay_id", *[f"{n}_{m}" for n in ("heartrate", "meanbp", "tempc", "resprate")
                        for m in ("min", "max")],
        col("glucose_min").alias("vglucose_min"), col("glucose_max").alias("vglucose_max"))
    lab = labs.select("icustay_id", *[f"{n}_{m}" for n in (
        "hematocrit", "wbc", "creatinine", "bun", "sodium", "albumin", "bilirubin")
        for m in ("min", "max")], col("glucose_min").alias("lglucose_min"),
        col("glucose_max").alias("lglucose_max"))
    gcs = c.get("gcs_min").select("icustay_id", "mingcs", "gcsmotor", "gcsverbal", "gcseyes",
                                  "endotrachflag")
    vent = c.get("vent_first_day").select("icustay_id", col("mechvent").alias("vent"))
    gases = c.get("stay_features").select("icustay_id", "pao2", "aado2", "acidbase_score")
    co = c.stay_join(c.get("stay_admission").select("subject_id", "hadm_id", "icustay_id", "admitted", "ckd"),
                     gases, vent, gcs, vit, uo, lab)
    co = co.withColumn("arf", F.when((col("creatinine_max") >= 1.5) & (col("urineoutput") < 410)
                                     & (col("ckd") == 0), 1).otherwise(0))
    # the widest range of both sources; greatest and least skip a missing one
    co = (co.withColumn("glucose_max", F.greatest("lglucose_max", "vglucose_max"))
          .withColumn("glucose_min", F.least("lglucose_min", "vglucose_min")))

    def side(name: str, m: str):
        x = col(f"{name}_{m}")
        edges, points = APS_BANDS[name]
        b = bands(x, edges, points)
        if name == "resprate":
            b = F.when(x.isNull(), None).when((col("vent") == 1) & (x < 14), 0).otherwise(b)
        if name == "creatinine":
            b = (F.when(x.isNull(), None).when((col("arf") == 1) & (x < 1.5), 0)
                 .when((col("arf") == 1) & (x >= 1.5), 10).otherwise(b))
        return b

    parts = {}
    for name, normal in APS_NORMALS.items():
        parts[f"{name}_score"] = worst_of(col(f"{name}_min"), col(f"{name}_max"),
                                          side(name, "min"), side(name, "max"), normal)
    cx, cn = col("creatinine_max"), col("creatinine_min")
    sx, sn = side("creatinine", "max"), side("creatinine", "min")
    parts["creatinine_score"] = F.when((col("arf") == 1) & cx.isNotNull(), sx).otherwise(
        worst_of(cn, cx, sn, sx, 1))
    parts["bun_score"] = F.when(col("bun_max").isNull(), None).otherwise(side("bun", "max"))
    parts["bilirubin_score"] = F.when(col("bilirubin_max").isNull(), None).otherwise(
        side("bilirubin", "max"))
    parts["uo_score"] = bands(col("urineoutput"), *APS_URINE)
    parts["gcs_score"] = rule_column(*rules.APS_GCS)
    parts["pao2_aado2_score"] = rule_column(*rules.APS_OXYGEN)
    renamed = {"heartrate_score": "hr_score", "tempc_score": "temp_score"}
    parts["acidbase_score"] = col("acidbase_score")
    # a stay without a known admission and patient has no score
    comp = co.select("subject_id", "hadm_id", "icustay_id", "admitted", *[
        F.when(col("admitted"), e).alias(renamed.get(n, n)) for n, e in parts.items()])
    scored = comp.withColumn("apsiii", F.when(col("admitted"), sum_scores(*[col(p) for p in APS_PARTS])))
    a, b = APS_PROB
    return scored.select("subject_id", "hadm_id", "icustay_id", "apsiii",
                         logistic(F.lit(a) + F.lit(b) * col("apsiii")).alias("apsiii_prob"),
                         *APS_PARTS)


@concept("sirs", "subject_id bigint, hadm_id bigint, icustay_id bigint, sirs int, "
                 "temp_score int, heartrate_score int, resp_score int, wbc_score int")
def sirs(c: Concepts):
    col = F.col
    bg = c.get("stay_features").select("icustay_id", "paco2_min")
    v = c.get("vitals_first_day").select("icustay_id", "tempc_min", "tempc_max",
                                        "heartrate_max", "resprate_max")
    lab = c.get("labs_first_day").select("icustay_id", "wbc_min", "wbc_max", "bands_max")
    co = c.stay_join(c.get("stay_admission").select("subject_id", "hadm_id", "icustay_id"), bg, v, lab)
    parts = co.select("subject_id", "hadm_id", "icustay_id",
                      *[rule_column(*rules.SIRS[n]).alias(n) for n in rules.SIRS])
    names = ["temp_score", "heartrate_score", "resp_score", "wbc_score"]
    return parts.select("subject_id", "hadm_id", "icustay_id",
                        sum_scores(*[col(n) for n in names]).alias("sirs"), *names)


@concept("severity_attach", """
    icustay_id bigint, subject_id bigint, hadm_id bigint, gender string, ethnicity string,
    admission_type string, admittime timestamp_ntz, dischtime timestamp_ntz,
    hospital_expire_flag string, icu_expire_flag string, hospstay_seq int,
    first_hosp_stay string, intime timestamp_ntz, outtime timestamp_ntz, age double,
    los_icu double, icustay_seq int, first_icu_stay string, weight double,
    ventnum bigint, starttime timestamp_ntz, endtime timestamp_ntz, duration_hours double,
    saps3 int, saps2 int, sofa_total int, sofa_respi int, sofa_coag int, sofa_liver int,
    sofa_cv int, sofa_neuro int, sofa_renal int""")
def severity_attach(c: Concepts):
    col = F.col
    aps = c.get("apsiii").select("icustay_id", col("apsiii").alias("saps3"))
    saps = c.get("sapsii").select("icustay_id", col("sapsii").alias("saps2"))
    so = c.get("sofa").select(
        "icustay_id", col("sofa").alias("sofa_total"), col("respiration").alias("sofa_respi"),
        col("coagulation").alias("sofa_coag"), col("liver").alias("sofa_liver"),
        col("cardiovascular").alias("sofa_cv"), col("cns").alias("sofa_neuro"),
        col("renal").alias("sofa_renal"))
    return (c.get("cohort_episodes").join(aps, "icustay_id").join(saps, "icustay_id")
            .join(so, "icustay_id"))
