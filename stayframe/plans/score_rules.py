"""The point rules of the scores, as ordered (condition, points).

First matching condition wins; ``None`` points mean NULL; a nested list is a
second-level rule list.  Conditions are SQL text over the named input columns
of each score, evaluated as written (``rules.rule_column``).  Each entry is
``component: (rules, points when nothing matches)``.  The oracle states the
same contract in its own form (``oracle.facts``).
"""

from __future__ import annotations

SOFA = {
    "respiration": ([
        ("pao2fio2_vent_min < 100", 4),
        ("pao2fio2_vent_min < 200", 3),
        ("pao2fio2_novent_min < 300", 2),
        ("pao2fio2_novent_min < 400", 1),
        ("coalesce(pao2fio2_vent_min, pao2fio2_novent_min) IS NULL", None),
    ], 0),
    "coagulation": ([
        ("platelet_min < 20", 4),
        ("platelet_min < 50", 3),
        ("platelet_min < 100", 2),
        ("platelet_min < 150", 1),
        ("platelet_min IS NULL", None),
    ], 0),
    "liver": ([
        ("bilirubin_max >= 12.0", 4),
        ("bilirubin_max >= 6.0", 3),
        ("bilirubin_max >= 2.0", 2),
        ("bilirubin_max >= 1.2", 1),
        ("bilirubin_max IS NULL", None),
    ], 0),
    "cardiovascular": ([
        ("rate_dopamine > 15 OR rate_epinephrine > 0.1 OR rate_norepinephrine > 0.1", 4),
        ("rate_dopamine > 5 OR rate_epinephrine <= 0.1 OR rate_norepinephrine <= 0.1", 3),
        ("rate_dopamine > 0 OR rate_dobutamine > 0", 2),
        ("meanbp_min < 70", 1),
        ("coalesce(meanbp_min, rate_dopamine, rate_dobutamine, rate_epinephrine, "
         "rate_norepinephrine) IS NULL", None),
    ], 0),
    "cns": ([
        ("mingcs >= 13 AND mingcs <= 14", 1),
        ("mingcs >= 10 AND mingcs <= 12", 2),
        ("mingcs >= 6 AND mingcs <= 9", 3),
        ("mingcs < 6", 4),
        ("mingcs IS NULL", None),
    ], 0),
    "renal": ([
        ("creatinine_max >= 5.0", 4),
        ("urineoutput < 200", 4),
        ("creatinine_max >= 3.5 AND creatinine_max < 5.0", 3),
        ("urineoutput < 500", 3),
        ("creatinine_max >= 2.0 AND creatinine_max < 3.5", 2),
        ("creatinine_max >= 1.2 AND creatinine_max < 2.0", 1),
        ("coalesce(urineoutput, creatinine_max) IS NULL", None),
    ], 0),
}

SAPSII = {
    "age_score": ([
        ("age IS NULL", None), ("age < 40", 0), ("age < 60", 7), ("age < 70", 12),
        ("age < 75", 15), ("age < 80", 16), ("age >= 80", 18),
    ], None),
    "hr_score": ([
        ("heartrate_max IS NULL", None),
        ("heartrate_min < 40", 11),
        ("heartrate_max >= 160", 7),
        ("heartrate_max >= 120", 4),
        ("heartrate_min < 70", 2),
        ("heartrate_max >= 70 AND heartrate_max < 120 AND heartrate_min >= 70 "
         "AND heartrate_min < 120", 0),
    ], None),
    "sysbp_score": ([
        ("sysbp_min IS NULL", None),
        ("sysbp_min < 70", 13),
        ("sysbp_min < 100", 5),
        ("sysbp_max >= 200", 2),
        ("sysbp_max >= 100 AND sysbp_max < 200 AND sysbp_min >= 100 AND sysbp_min < 200", 0),
    ], None),
    "temp_score": ([
        ("tempc_max IS NULL", None), ("tempc_min < 39.0", 0), ("tempc_max >= 39.0", 3),
    ], None),
    "pao2fio2_score": ([
        ("pao2fio2_vent_min IS NULL", None), ("pao2fio2_vent_min < 100", 11),
        ("pao2fio2_vent_min < 200", 9), ("pao2fio2_vent_min >= 200", 6),
    ], None),
    "uo_score": ([
        ("urineoutput IS NULL", None), ("urineoutput < 500.0", 11),
        ("urineoutput < 1000.0", 4), ("urineoutput >= 1000.0", 0),
    ], None),
    "bun_score": ([
        ("bun_max IS NULL", None), ("bun_max < 28.0", 0), ("bun_max < 83.0", 6),
        ("bun_max >= 84.0", 10),
    ], None),
    "wbc_score": ([
        ("wbc_max IS NULL", None),
        ("wbc_min < 1.0", 12),
        ("wbc_max >= 20.0", 3),
        ("wbc_max >= 1.0 AND wbc_max < 20.0 AND wbc_min >= 1.0 AND wbc_min < 20.0", 0),
    ], None),
    "potassium_score": ([
        ("potassium_max IS NULL", None),
        ("potassium_min < 3.0", 3),
        ("potassium_max >= 5.0", 3),
        ("potassium_max >= 3.0 AND potassium_max < 5.0 AND potassium_min >= 3.0 "
         "AND potassium_min < 5.0", 0),
    ], None),
    "sodium_score": ([
        ("sodium_max IS NULL", None),
        ("sodium_min < 125", 5),
        ("sodium_max >= 145", 1),
        ("sodium_max >= 125 AND sodium_max < 145 AND sodium_min >= 125 AND sodium_min < 145", 0),
    ], None),
    "bicarbonate_score": ([
        ("bicarbonate_max IS NULL", None),
        ("bicarbonate_min < 15.0", 5),
        ("bicarbonate_min < 20.0", 3),
        ("bicarbonate_max >= 20.0 AND bicarbonate_min >= 20.0", 0),
    ], None),
    "bilirubin_score": ([
        ("bilirubin_max IS NULL", None), ("bilirubin_max < 4.0", 0),
        ("bilirubin_max < 6.0", 4), ("bilirubin_max >= 6.0", 9),
    ], None),
    "gcs_score": ([
        ("mingcs IS NULL", None), ("mingcs < 3", None), ("mingcs < 6", 26),
        ("mingcs < 9", 13), ("mingcs < 11", 7), ("mingcs < 14", 5),
        ("mingcs >= 14 AND mingcs <= 15", 0),
    ], None),
    "comorbidity_score": ([
        ("aids = 1", 17), ("hem = 1", 10), ("mets = 1", 9),
    ], 0),
    "admissiontype_score": ([
        ("admissiontype = 'ScheduledSurgical'", 0), ("admissiontype = 'Medical'", 6),
        ("admissiontype = 'UnscheduledSurgical'", 8),
    ], None),
}

SIRS = {
    "temp_score": ([
        ("tempc_min < 36.0", 1), ("tempc_max > 38.0", 1), ("tempc_min IS NULL", None),
    ], 0),
    "heartrate_score": ([
        ("heartrate_max > 90.0", 1), ("heartrate_max IS NULL", None),
    ], 0),
    "resp_score": ([
        ("resprate_max > 20.0", 1), ("paco2_min < 32.0", 1),
        ("coalesce(resprate_max, paco2_min) IS NULL", None),
    ], 0),
    "wbc_score": ([
        ("wbc_min < 4.0", 1), ("wbc_max > 12.0", 1), ("bands_max > 10", 1),
        ("coalesce(wbc_min, bands_max) IS NULL", None),
    ], 0),
}

# APS III acid-base points: pH band first, then PaCO2 within it.
APS_ACIDBASE = ([
    ("ph IS NULL OR pco2 IS NULL", None),
    ("ph < 7.20", [("pco2 < 50", 12), ("TRUE", 4)]),
    ("ph < 7.30", [("pco2 < 30", 9), ("pco2 < 40", 6), ("pco2 < 50", 3), ("TRUE", 2)]),
    ("ph < 7.35", [("pco2 < 30", 9), ("pco2 < 45", 0), ("TRUE", 1)]),
    ("ph < 7.45", [("pco2 < 30", 5), ("pco2 < 45", 0), ("TRUE", 1)]),
    ("ph < 7.50", [("pco2 < 30", 5), ("pco2 < 35", 0), ("pco2 < 45", 2), ("TRUE", 12)]),
    ("ph < 7.60", [("pco2 < 40", 3), ("TRUE", 12)]),
    ("TRUE", [("pco2 < 25", 0), ("pco2 < 40", 3), ("TRUE", 12)]),
], None)

# APS III neurologic points by eyes, verbal and motor components.
APS_GCS = ([
    ("endotrachflag = 1", 0),
    ("gcseyes = 1", [
        ("gcsverbal = 1 AND gcsmotor IN (1, 2)", 48),
        ("gcsverbal = 1 AND gcsmotor IN (3, 4)", 33),
        ("gcsverbal = 1 AND gcsmotor IN (5, 6)", 16),
        ("gcsverbal IN (2, 3) AND gcsmotor IN (1, 2)", 29),
        ("gcsverbal IN (2, 3) AND gcsmotor IN (3, 4)", 24),
        ("gcsverbal IN (2, 3) AND gcsmotor >= 5", None),
        ("gcsverbal >= 4", None),
    ]),
    ("gcseyes > 1", [
        ("gcsverbal = 1 AND gcsmotor IN (1, 2)", 29),
        ("gcsverbal = 1 AND gcsmotor IN (3, 4)", 24),
        ("gcsverbal = 1 AND gcsmotor IN (5, 6)", 15),
        ("gcsverbal IN (2, 3) AND gcsmotor IN (1, 2)", 29),
        ("gcsverbal IN (2, 3) AND gcsmotor IN (3, 4)", 24),
        ("gcsverbal IN (2, 3) AND gcsmotor = 5", 13),
        ("gcsverbal IN (2, 3) AND gcsmotor = 6", 10),
        ("gcsverbal = 4 AND gcsmotor IN (1, 2, 3, 4)", 13),
        ("gcsverbal = 4 AND gcsmotor = 5", 8),
        ("gcsverbal = 4 AND gcsmotor = 6", 3),
        ("gcsverbal = 5 AND gcsmotor IN (1, 2, 3, 4, 5)", 3),
        ("gcsverbal = 5 AND gcsmotor = 6", 0),
    ]),
], None)

# APS III oxygenation: PaO2 when present, else AaDO2.
APS_OXYGEN = ([
    ("pao2 IS NULL AND aado2 IS NULL", None),
    ("pao2 IS NOT NULL", [("pao2 < 50", 15), ("pao2 < 70", 5), ("pao2 < 80", 2), ("TRUE", 0)]),
    ("aado2 IS NOT NULL", [("aado2 < 100", 0), ("aado2 < 250", 7), ("aado2 < 350", 9),
                           ("aado2 < 500", 11), ("aado2 >= 500", 14), ("TRUE", 0)]),
], None)

# KDIGO stage per 6-h bin; stage 1 is tested first, no stage 0.
KDIGO = ([
    ("(creat_max / mdrd_creat75 BETWEEN 1.5 AND 1.9) OR (creat_max - mdrd_creat75 >= 26.5) "
     "OR (urine_6h_kgh < 0.5 AND urine_12h_kgh >= 0.5 AND urine_24h_kgh >= 3)", 1),
    ("(creat_max / mdrd_creat75 BETWEEN 2 AND 2.9) "
     "OR (urine_12h_kgh < 0.5 AND urine_24h_kgh >= 0.3)", 2),
    ("(creat_max / mdrd_creat75 >= 3) OR (creat_max - mdrd_creat75 >= 353.6) "
     "OR urine_24h_kgh < 0.3 OR urine_12h_kgh = 0 OR rrt = 1", 3),
], None)
