"""Hand-made frames for score bands, ICD ranges, GCS and the J9 outer-merge trap."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stayframe.functions.scoring import bands
from stayframe.plans import registry  # noqa: F401  (registers concepts)
from stayframe.plans.base import BUILDERS, Concepts
from stayframe.plans.severity import APS_BANDS

T0 = dt.datetime(2024, 1, 1)


def _concepts(spark, **tables):
    return Concepts(SimpleNamespace(spark=spark, run_id="t", **tables), materialize=False)


@pytest.mark.parametrize("name", sorted(APS_BANDS))
def test_band_edges(spark, name):
    edges, points = APS_BANDS[name]
    xs = sorted({float(x) for e in edges for x in (e - 1e-6, e, e + 1e-6)})

    def brute(x):
        for e, p in zip(edges, points):
            if x < e:
                return p
        return points[-1]

    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    got = {r.x: r.s for r in df.select("x", bands(F.col("x"), edges, points).alias("s"))
           .collect()}
    assert got == {**{x: brute(x) for x in xs}, None: None}


def test_icd_char5_ranges(spark):
    codes = [(1, "042"), (2, "0420"), (3, "0449"), (4, "04499"), (5, "2386"), (6, "V10"),
             (7, "20302"), (8, "1990"), (9, "78951")]
    dx = spark.createDataFrame([(h, h, 1, code) for h, code in codes],
                               "hadm_id long, subject_id long, seq_num long, icd9_code string")
    c = _concepts(spark, diagnoses_icd=dx)
    got = {r.hadm_id: (r.aids, r.hem, r.mets) for r in c.get("comorbidity_flags").collect()}
    assert got[1] == (1, None, None)       # '042  ' is the lower bound
    assert got[2] == (1, None, None)       # '0420 ' inside
    assert got[3] == (1, None, None)       # '0449 ' upper bound
    assert got[4] == (None, None, None)    # '04499' > '0449 '
    assert got[5] == (None, 1, None)       # exact '2386 '
    assert got[6] == (None, None, None)
    assert got[7] == (None, 1, None)       # in two overlapping ranges
    assert got[8] == (None, None, 1)
    assert got[9] == (None, None, 1)


def test_gcs_rules(spark):
    def t(h):
        return T0 + dt.timedelta(hours=h)
    stays = spark.createDataFrame([(1, 1, 10, T0, t(72), "carevue")],
                                  "subject_id long, hadm_id long, icustay_id long, "
                                  "intime timestamp_ntz, outtime timestamp_ntz, dbsource string")
    rows = [  # (time h, itemid, value, valuenum)
        (1, 723, "1.0 ET/Trach", 1.0), (1, 454, "x", 3.0), (1, 184, "x", 2.0),   # intubated
        (2, 454, "x", 4.0), (2, 184, "x", 3.0),               # verbal missing, prev intubated
        (9, 723, "x", 3.0), (9, 454, "x", 5.0),               # > 6 h later: defaults fill eyes
        (14, 723, "x", 2.0), (14, 454, "x", 2.0), (14, 184, "x", 1.0),  # lowest: 5
    ]
    ce = spark.createDataFrame(
        [(i, 1, 1, 10, item, t(h), val, num, None) for i, (h, item, val, num) in enumerate(rows)],
        "row_id long, subject_id long, hadm_id long, icustay_id long, itemid long, "
        "charttime timestamp_ntz, value string, valuenum double, error int")
    c = _concepts(spark, icustays=stays, chartevents=ce)
    r = c.get("gcs_min").collect()[0]
    assert (r.mingcs, r.gcsmotor, r.gcsverbal, r.gcseyes, r.endotrachflag) == \
        (5.0, 2.0, 2.0, 1.0, 0)


def test_outer_merge_keys_only_in_later_inputs(spark):
    """A (stay, day) present in urine and rrt but not creatinine gives two rows."""
    c = _concepts(spark)
    c._memo["creat_daily"] = spark.createDataFrame([(1, 200.0, 1)],
                                                   "icustay_id long, creat double, day long")
    c._memo["urine_binned"] = spark.createDataFrame(
        [(1, 5, 3, 2, 0.4, 0.6, 0.7)],
        "icustay_id long, day_6h long, day_12h long, day_24h long, urine_6h_kgh double, "
        "urine_12h_kgh double, urine_24h_kgh double")
    c._memo["rrt_daily"] = spark.createDataFrame([(1, 1, 2)], "icustay_id long, rrt int, day long")
    c._memo["cohort"] = spark.createDataFrame(
        [(1, 60.0, "WHITE", "M")], "icustay_id long, age double, ethnicity string, gender string")
    got = sorted(((r.day_24h, r.rrt, r.urine_24h_kgh) for r in BUILDERS["kdigo_stage"](c)
                  .collect()), key=repr)
    assert got == sorted([(1, None, None), (2, None, 0.7), (2, 1, None)], key=repr)


def test_vent_flags_trailing_space_devices(spark):
    """Device names are matched exactly, trailing spaces included (T7 trap)."""
    from stayframe.plans.ventilation import vent_flags
    vals = [(226732, "Trach mask "), (226732, "Trach mask"), (720, "Other/Remarks"),
            (720, "SIMV"), (640, "Self Extubation")]
    rows = [(1, T0 + dt.timedelta(minutes=i), item, v) for i, (item, v) in enumerate(vals)]
    df = spark.createDataFrame(rows, "icustay_id long, charttime timestamp_ntz, itemid long, "
                                     "value string")
    joined = vent_flags(df).join(df, ["icustay_id", "charttime", "itemid"])
    flags = {(r.value, r.mechvent, r.extubated, r.selfextubated) for r in joined.collect()}
    assert len(flags) == len(vals)
    assert ("Trach mask ", 0, 1, 0) in flags
    assert ("Trach mask", 0, 0, 0) in flags
    assert ("Other/Remarks", 0, 0, 0) in flags
    assert ("SIMV", 1, 0, 0) in flags
    assert ("Self Extubation", 0, 1, 1) in flags


def test_aps_pick_nulls_first_and_mask_after_rank(spark):
    """W3 + N4: row numbers over all gases (NULL AaDO2 first), masked afterwards."""
    def t(h):
        return T0 + dt.timedelta(hours=h)
    gas = spark.createDataFrame([
        (1, t(1), 80.0, None, 60.0, None),    # NULL AaDO2 ranks first (DESC NULLS FIRST)
        (1, t(2), 90.0, 300.0, 60.0, None),
        (2, t(1), 95.0, 200.0, None, None),   # no FiO2: AaDO2 pick masked, PaO2 kept
        (2, t(2), 70.0, 100.0, 40.0, None),   # FiO2 >= 0.5 (a percentage): PaO2 masked
    ], "icustay_id long, charttime timestamp_ntz, po2 double, aado2 double, fio2 double, "
       "fio2_chartevents double")
    vd = spark.createDataFrame([(1, t(0), t(5))], "icustay_id long, starttime timestamp_ntz, "
                                                  "endtime timestamp_ntz")
    c = _concepts(spark)
    c._memo["blood_gas_arterial"] = gas
    c._memo["vent_durations"] = vd
    got = {(r.icustay_id, r.charttime): (r.aado2_rn, r.pao2_rn)
           for r in BUILDERS["aps_gas_pick"](c).collect()}
    assert got[(1, t(1))] == (1, None)       # ventilated: PaO2 pick masked
    assert got[(1, t(2))] == (2, None)
    assert got[(2, t(1))] == (None, 1)       # highest PaO2, not ventilated, no FiO2
    assert got[(2, t(2))] == (None, None)    # rank 2 and masked by FiO2 >= 0.5
