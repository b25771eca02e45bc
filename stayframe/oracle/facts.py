"""Fixed values of the oracle queries, stated here on their own.

The Spark side states the same contract values in ``stayframe.plans``; nothing
is shared, so a wrong value on either side shows as a mismatch.
"""

from __future__ import annotations

# --- units ---
LB_KG, LB_KG_EXACT, OZ_KG, IN_CM, CREAT_UMOL = 0.453592, 0.45359237, 0.0283495231, 2.54, 88

# --- ventilation ---
VENT_SETTINGS = """
    1 60 157 158 218 221 223 436 437 444 445 448 449 450 459 501 502 503 505 506 535 543 639 654
    667 668 669 670 671 672 681 682 683 684 686 1211 1340 1486 1600 1655 1852 2000 3398 3399 3400
    3401 3402 3403 3404 3459 5865 5866 8382 220339 224419 224684 224685 224686 224687 224695
    224696 224697 224700 224701 224702 224705 224706 224707 224709 224738 224746 224747 224750
    226873 227187 227809 227810"""
VENT_OTHER_SCANNED = "467 468 469 470 471 640 648 720 223834 223848 226732 227287"
MASKS_226732 = ("Nasal cannula", "Face tent", "Aerosol-cool", "Trach mask ", "High flow neb", "Non-rebreather",
                "Venti mask ", "Medium conc mask ", "T-piece", "High flow nasal cannula", "Ultrasonic neb", "Vapomist")
MASKS_467 = ("Cannula", "Nasal Cannula", "None", "Face Tent", "Aerosol-Cool", "Trach Mask", "Hi Flow Neb",
             "Non-Rebreather", "Venti Mask", "Medium Conc Mask", "Vapotherm", "T-Piece", "Hood", "Hut",
             "TranstrachealCat", "Heated Neb", "Ultrasonic Neb")
EXTUBATION_PROCEDURES = {227194: 0, 225468: 1, 225477: 1}  # item -> by the patient

# --- daily pressures: concept -> (day style, value items, items that only date the origin) ---
PRESSURES = {
    "peep": ("open", "505 506 220339 224700", "465 466 12750 13253"),
    "paw": ("open", "224697", ""),
    "pplat": ("half_mixed", "224696", ""),
    "cvp": ("half_mixed", "220074", ""),
}

# --- haemodynamics ---
MAP_ITEMS, CVP_ITEMS = "52 443 456 6702 220052 220181 225312", "113 1103 220074"

# --- enzymes and vasopressors: name -> (day style, items) ---
ENZYMES = {"asat": ("closed_hi", "769"), "alat": ("closed_hi", "770"), "alp": ("closed_hi", "773"),
           "bili": ("bili", "1538 225690")}
DRUGS = {"norepi": ("h24", "30047 30120"), "epi": ("h24", "30044 30119 30309"), "dopamine": ("h24", "30043 30307"),
         "dobutamine": ("h24", "30042 30306"), "vasopressine": ("h24_late", "30051")}

# --- kidney ---
CREATININE = "50912 51081"
URINE = """
    40055 40056 40057 40069 40085 40086 40094 40096 40405 40428 40473 40651 40715 43175 226557 226558
    226559 226560 226561 226563 226564 226565 226567 226584 227488 227489"""
IRRIGANT = 227489
DIALYSIS_ANY_TEXT = "146 147 148 149 150 151 152"
DIALYSIS_LINES = "229 235 241 247 253 259 265 271"
DIALYSIS_STEPS = ("CAVH Start", "CAVH D/C", "CVVHD Start", "CVVHD D/C", "Hemodialysis st", "Hemodialysis end")
DIALYSIS_CHART_MV = """
    224144 224145 224149 224150 224151 224152 224153 224154 224191 224404 224406 225126 225183 225725
    225806 225807 225810 226118 226457 226499 227357 227438 227639 228004 228005 228006"""
DIALYSIS_INPUT_MV, DIALYSIS_DATETIME = "227525 227536", "225318 225319 225321 225322 225324"
DIALYSIS_PROCEDURE = "224270 225436 225441 225802 225803 225805 225809 225955"

# --- first-day vitals: (name, items, above, below, the upper bound itself allowed, Fahrenheit) ---
VITALS = (
    ("heartrate", "211 220045", 0, 300, False, False),
    ("sysbp", "51 442 455 6701 220050 220179", 0, 400, False, False),
    ("diasbp", "8368 8440 8441 8555 220051 220180", 0, 300, False, False),
    ("meanbp", "52 443 456 6702 220052 220181 225312", 0, 300, False, False),
    ("resprate", "615 618 220210 224690", 0, 70, False, False),
    ("tempc", "678 223761", 70, 120, False, True),
    ("tempc", "676 223762", 10, 50, False, False),
    ("spo2", "646 220277", 0, 100, True, False),
    ("glucose", "807 811 1529 3744 3745 220621 225664 226537", 0, 1e300, False, False),
)
VITAL_ORDER = ("heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "glucose")

# --- first-day labs: name -> (upper bound or None, items) ---
LABS = {
    "aniongap": (10000, "50868"), "albumin": (10, "50862"), "bands": (100, "51144"), "bicarbonate": (10000, "50882"),
    "bilirubin": (150, "50885"), "creatinine": (150, "50912"), "chloride": (10000, "50806 50902"),
    "glucose": (10000, "50809 50931"), "hematocrit": (100, "50810 51221"), "hemoglobin": (50, "50811 51222"),
    "lactate": (50, "50813"), "platelet": (10000, "51265"), "potassium": (30, "50822 50971"), "ptt": (150, "51275"),
    "inr": (50, "51237"), "pt": (150, "51274"), "sodium": (200, "50824 50983"), "bun": (300, "51006"),
    "wbc": (1000, "51300 51301"),
}

# --- blood gases: item -> name (50807 and 51545 are read but have none), and upper bounds by name ---
GASES = dict(zip(
    [i for i in range(50800, 50829) if i != 50807],
    """specimen aado2 baseexcess bicarbonate totalco2 carboxyhemoglobin chloride calcium glucose hematocrit
    hemoglobin intubated lactate methemoglobin o2flow fio2 so2 pco2 peep ph po2 potassium requiredo2 sodium
    temperature tidalvolume ventilationrate ventilator""".split()))
GAS_LIMITS = {"hematocrit": 100, "fio2": 100, "so2": 100, "o2flow": 70, "po2": 800}

# --- arterial specimen model: name -> (coefficient, mean, offset when missing) ---
SPECIMEN = {
    "spo2": ("-0.15356", "97.49420", "0.13429"), "fio2_chartevents": ("0.00621", "51.49550", "-0.24958"),
    "hemoglobin": ("0.10559", "10.32307", "0.05954"), "so2": ("0.13251", "93.66539", "-0.23172"),
    "pco2": ("-0.01511", "42.08866", "-0.01630"), "fio2": ("0.01480", "63.97836", "-0.31142"),
    "aado2": ("-0.00200", "442.21186", "-0.01328"), "bicarbonate": ("-0.03220", "22.96894", "-0.06535"),
    "totalco2": ("0.05384", "24.72632", "-0.01405"), "lactate": ("0.08202", "3.06436", "0.06038"),
    "ph": ("0.10956", "7.36233", "-0.00617"), "o2flow": ("0.00848", "7.59362", "-0.35803"),
}
SPECIMEN_BASE, SPECIMEN_PO2 = "-0.02544", "0.04598"

# --- height and weight ---
HEIGHT_CM, HEIGHT_IN = "3485 4188 226730", "920 1394 3486 4187"
WEIGHT_KG_DOSING = "762 763 3580 3723 226512"

# --- comorbidities: ICD-9 codes of five characters, (from, to) ---
AIDS = (("042  ", "0449 "),)
BLOOD_CANCER = (("20000", "20238"), ("20240", "20248"), ("20250", "20302"), ("20302", "20382"), ("20310", "20312"),
                ("20400", "20522"), ("20580", "20702"), ("20720", "20892"), ("2386 ", "2386 "), ("2733 ", "2733 "))
METASTASIS = (("1960 ", "1991 "), ("20970", "20975"), ("20979", "20979"), ("78951", "78951"))

# --- APS III: name -> (normal value, edges, points); None: not judged by distance ---
APS = {
    "heartrate": (75, (40, 50, 100, 110, 120, 140, 155), (8, 5, 0, 1, 5, 7, 13, 17)),
    "meanbp": (90, (40, 60, 70, 80, 100, 120, 130, 140), (23, 15, 7, 6, 0, 4, 7, 9, 10)),
    "tempc": (38, (33, 33.5, 34, 35, 36, 40), (20, 16, 13, 8, 2, 0, 4)),
    "resprate": (19, (6, 12, 14, 25, 35, 40, 50), (17, 8, 7, 0, 6, 9, 11, 18)),
    "hematocrit": (45.5, (41, 50), (3, 0, 3)),
    "wbc": (11.5, (1, 3, 20, 25), (19, 5, 0, 1, 5)),
    "creatinine": (1, (0.5, 1.5, 1.95), (3, 0, 4, 7)),
    "bun": (None, (17, 20, 40, 80), (0, 2, 7, 11, 12)),
    "sodium": (145.5, (120, 135, 155), (3, 2, 0, 4)),
    "albumin": (3.5, (2, 2.5, 4.5), (11, 6, 0, 4)),
    "bilirubin": (None, (2, 3, 5, 8), (0, 5, 6, 8, 16)),
    "glucose": (130, (40, 60, 200, 350), (8, 9, 0, 3, 5)),
}
APS_URINE = ((400, 600, 900, 1500, 2000, 4000), (15, 8, 7, 5, 4, 0, 1))
#: pH from, pH to, pCO2 edges, points
APS_ACID = (
    (None, 7.20, (50,), (12, 4)), (7.20, 7.30, (30, 40, 50), (9, 6, 3, 2)), (7.30, 7.35, (30, 45), (9, 0, 1)),
    (7.35, 7.45, (30, 45), (5, 0, 1)), (7.45, 7.50, (30, 35, 45), (5, 0, 2, 12)), (7.50, 7.60, (40,), (3, 12)),
    (7.60, None, (25, 40), (0, 3, 12)),
)
#: eyes open, verbal from, verbal to, then points by motor 1 to 6 (None: no points)
APS_NEURO = (
    (False, 1, 1, (48, 48, 33, 33, 16, 16)), (False, 2, 3, (29, 29, 24, 24, None, None)),
    (True, 1, 1, (29, 29, 24, 24, 15, 15)), (True, 2, 3, (29, 29, 24, 24, 13, 10)),
    (True, 4, 4, (13, 13, 13, 13, 8, 3)), (True, 5, 5, (3, 3, 3, 3, 3, 0)),
)
APS_PAO2 = ((50, 70, 80), (15, 5, 2, 0))
APS_AADO2 = ((100, 250, 350, 500), (0, 7, 9, 11, 14))
APS_LOGIT = (-4.4360, 0.04726)

# --- SAPS II: bands of one value, (edges, points) ---
SAPS_BANDS = {
    "age_score": ("age", (40, 60, 70, 75, 80), (0, 7, 12, 15, 16, 18)),
    "pao2fio2_score": ("pf_vent", (100, 200), (11, 9, 6)),
    "uo_score": ("urineoutput", (500, 1000), (11, 4, 0)),
    "bilirubin_score": ("bilirubin_max", (4, 6), (0, 4, 9)),
    "gcs_score": ("mingcs", (3, 6, 9, 11, 14, 15.0000001), (None, 26, 13, 7, 5, 0, None)),
    "bun_score": ("bun_max", (28, 83, 84), (0, 6, None, 10)),
}
SAPS_LOGIT = (-7.7631, 0.0737, 0.9971)
