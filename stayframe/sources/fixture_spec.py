"""Recipe that turns the driver's generic ``events`` stream into clinical tables.

The driver ships TPC-H-like tables plus an ``events`` stream; the cohort
pipelines need ICU tables (stays, chart/lab/output/input events ...).  This
module holds the *recipe* as plain data: every derived value is a SQL
expression string that means the same thing in Spark SQL and in DuckDB, so the
Spark build (``sources.fixture``) and the DuckDB oracle (``oracle.fixture_sql``)
read literally the same definitions.

Columns visible to the expressions of an event role: ``event_id``,
``event_type``, ``value`` (double), ``subject_id``, ``hadm_id``,
``icustay_id``, ``charttime``.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values of the recipe (derivation rules, not reference constants).
# ---------------------------------------------------------------------------
EPOCH = "2024-01-01 00:00:00"  # origin of stay times
STAY_SPACING_DAYS = 10  # stay k starts 10*k days after the subject's origin, up to the last event
ID_STRIDE = 100_003  # ids of a subject's stays and admissions start at subject * stride
EVENT_TYPES = ("view", "click", "purchase", "error", "signup")

# A valuenum is NULL on every 37th event; ``error`` is 1 / 0 / NULL.
NULL_VALUENUM = "event_id % 37 = 0"
ERROR_FLAG = "CASE WHEN event_id % 50 = 0 THEN 1 WHEN event_id % 3 = 0 THEN 0 END"


def by_type(*choices: str) -> str:
    """CASE over the five event types, in the order of ``EVENT_TYPES``."""
    arms = " ".join(
        f"WHEN event_type = '{t}' THEN {c}" for t, c in zip(EVENT_TYPES, choices)
    )
    return f"CASE {arms} END"


def num(expr: str) -> str:
    """Numeric value with the NULL rule applied, as DOUBLE in both engines."""
    return f"CASE WHEN {NULL_VALUENUM} THEN NULL ELSE CAST({expr} AS DOUBLE) END"


@dataclass(frozen=True)
class Row:
    itemid: str
    value: str = "'x'"
    valuenum: str = "NULL"


@dataclass(frozen=True)
class Role:
    """One event becomes ``len(rows)`` rows of ``table`` when ``where`` holds."""

    name: str
    table: str
    rows: tuple
    where: str = "TRUE"


ROLES: tuple[Role, ...] = (
    # -- chartevents ------------------------------------------------------
    Role("vent", "chartevents", (Row(
        itemid=by_type("720", "445", "640", "467", "467"),
        value=by_type(
            "CASE WHEN event_id % 10 = 0 THEN 'Other/Remarks' ELSE 'SIMV' END",
            "'MV'",
            "CASE WHEN event_id % 4 = 0 THEN 'Self Extubation' ELSE 'Extubated' END",
            "CASE WHEN event_id % 3 = 0 THEN 'CPAP mask' ELSE 'Nasal Cannula' END",
            "CASE WHEN event_id % 2 = 0 THEN 'Ventilator' ELSE 'Other' END"),
        valuenum=num("value / 20")),)),
    Role("pressure", "chartevents", (Row(
        itemid=by_type("505", "506", "220339", "224697", "224696"),
        value="'set'",
        valuenum=num("value / 10 + 2")),)),
    Role("hemo", "chartevents", (Row(
        itemid=by_type("52", "220052", "220074", "113", "456"),
        valuenum=num(by_type("value / 2 + 40", "value / 2 + 40", "value / 10",
                             "value / 10", "value / 2 + 30"))),)),
    Role("gcs", "chartevents", (
        Row(itemid="CASE WHEN subject_id % 2 = 1 THEN 454 ELSE 223901 END",
            valuenum=num("1 + event_id % 6")),
        Row(itemid="CASE WHEN subject_id % 2 = 1 THEN 723 ELSE 223900 END",
            value="CASE WHEN event_id % 7 = 0 THEN CASE WHEN subject_id % 2 = 1 "
                  "THEN '1.0 ET/Trach' ELSE 'No Response-ETT' END ELSE 'x' END",
            valuenum=num("1 + event_id % 5")),
        Row(itemid="CASE WHEN subject_id % 2 = 1 THEN 184 ELSE 220739 END",
            valuenum=num("1 + event_id % 4")),
    ), where="event_type IN ('view', 'click', 'error')"),
    Role("vitals", "chartevents", (Row(
        itemid=by_type("211", "455", "678", "618", "646"),
        valuenum=num(by_type("value / 2 + 30", "value / 2 + 50", "90 + value / 25",
                             "5 + value / 5", "100 - value / 10"))),)),
    Role("vitals2", "chartevents", (Row(
        itemid=by_type("8368", "223762", "807", "220045", "220181"),
        valuenum=num(by_type("value / 4 + 20", "32 + value / 50", "30 + value * 2",
                             "value / 2 + 30", "value / 2 + 35"))),)),
    Role("body", "chartevents", (Row(
        itemid=by_type("762", "763", "226512", "920", "226730"),
        valuenum=num(by_type("40 + value / 4", "40 + value / 4", "40 + value / 4",
                             "55 + value / 20", "140 + value / 10"))),)),
    Role("liver", "chartevents", (Row(
        itemid=by_type("769", "770", "773", "1538", "225690"),
        valuenum=num(by_type("value", "value", "value * 2", "value / 10", "value / 10"))),)),
    Role("resp", "chartevents", (Row(
        itemid=by_type("223835", "190", "220277", "220210", "467"),
        value=by_type("'x'", "'x'", "'x'", "'x'",
                      "CASE WHEN event_id % 2 = 0 THEN 'BiPAP mask' ELSE 'Cannula' END"),
        valuenum=num(by_type("21 + event_id % 80", "(21 + event_id % 80) / 100",
                             "100 - value / 10", "5 + value / 5", "value"))),)),
    Role("rrt", "chartevents", (Row(
        itemid=by_type("152", "229", "582", "224144", "225126"),
        value=by_type(
            "'CVVHD'",
            "CASE WHEN event_id % 2 = 0 THEN 'Dialysis Line' ELSE 'Arterial' END",
            "CASE WHEN event_id % 2 = 0 THEN 'CVVHD Start' ELSE 'Other' END",
            "'x'", "'Y'"),
        valuenum=num(by_type("1", "1", "1", "value - 10", "1"))),)),
    # -- labevents (no icustay_id in the output table) ----------------------
    Role("lab", "labevents", (Row(
        itemid=by_type("50912", "50885", "51265", "51006", "51301"),
        valuenum=num(by_type("value / 20", "value / 10", "value * 2", "value / 2",
                             "value / 10"))),)),
    Role("lab2", "labevents", (Row(
        itemid=by_type("50862", "50882", "50971", "50983", "51221"),
        valuenum=num(by_type("1 + value / 100", "5 + value / 10", "2 + value / 50",
                             "120 + value / 10", "20 + value / 10"))),)),
    Role("gas", "labevents", (
        Row(itemid="50821", valuenum=num("40 + value")),
        Row(itemid="50818", valuenum=num("20 + value / 5")),
        Row(itemid="50820", valuenum=num("7 + (event_id % 80) / 100")),
        Row(itemid="50816", valuenum=num("21 + event_id % 80")),
        Row(itemid="50800",
            value="CASE WHEN event_id % 3 = 0 THEN 'VEN' ELSE 'ART' END"),
    ), where="event_type IN ('view', 'purchase', 'signup')"),
    # -- outputevents -------------------------------------------------------
    Role("urine", "outputevents", (Row(
        itemid=by_type("40055", "226559", "227489", "40069", "226560"),
        valuenum=num("value * 4")),)),
    # -- inputevents (CareVue: charttime/rate; MetaVision: starttime/rate/amount)
    Role("vaso_cv", "inputevents_cv", (Row(
        itemid=by_type("30047", "30044", "30043", "30042", "30051"),
        valuenum=num("value / 100")),)),
    Role("vaso_mv", "inputevents_mv", (Row(
        itemid=by_type("221906", "221289", "221662", "221653", "227536"),
        value="CASE WHEN event_id % 5 = 0 THEN 'Rewritten' "
              "WHEN event_id % 7 = 0 THEN NULL ELSE 'FinishedRunning' END",
        valuenum=num("value / 100")),)),
    # -- procedureevents_mv / datetimeevents ---------------------------------
    Role("proc", "procedureevents_mv", (Row(
        itemid="CASE WHEN event_id % 3 = 0 THEN 227194 WHEN event_id % 3 = 1 "
               "THEN 225468 ELSE 225802 END",
        valuenum=num("1")),), where="event_type = 'purchase'"),
    Role("dtevent", "datetimeevents", (Row(itemid="225318"),),
         where="event_type = 'error'"),
)

ROLE_NO = {r.name: i for i, r in enumerate(ROLES)}

# Column lists of the derived event tables (name -> SQL over the role columns).
EVENT_TABLE_COLUMNS = {
    "chartevents": ("row_id", "subject_id", "hadm_id", "icustay_id", "itemid",
                    "charttime", "value", "valuenum", "error"),
    "labevents": ("row_id", "subject_id", "hadm_id", "itemid", "charttime", "value",
                  "valuenum"),
    "outputevents": ("row_id", "subject_id", "hadm_id", "icustay_id", "itemid",
                     "charttime", "value"),
    "inputevents_cv": ("row_id", "subject_id", "icustay_id", "itemid", "charttime",
                       "rate"),
    "inputevents_mv": ("row_id", "subject_id", "icustay_id", "itemid", "starttime",
                       "rate", "amount", "statusdescription"),
    "procedureevents_mv": ("row_id", "subject_id", "icustay_id", "itemid", "starttime",
                           "value"),
    "datetimeevents": ("row_id", "subject_id", "icustay_id", "itemid", "charttime"),
}

# How the generic role columns (itemid, value, valuenum, charttime) map onto the
# table columns.  Anything not listed keeps its own name.
COLUMN_SOURCES = {
    "chartevents": {"error": ERROR_FLAG},
    "labevents": {},
    "outputevents": {"value": "valuenum"},
    "inputevents_cv": {"rate": "valuenum"},
    "inputevents_mv": {"starttime": "charttime", "rate": "valuenum",
                       "amount": "valuenum * 10", "statusdescription": "value"},
    "procedureevents_mv": {"starttime": "charttime", "value": "valuenum"},
    "datetimeevents": {},
}

# Stay / admission / patient rules (u = subject_id = user_id, k = 0, 1, ...):
# two stays in a row belong to one admission.
STAY_RULES = {
    "hadm_id": f"u * {ID_STRIDE} + CAST(floor(k / 2) AS BIGINT)",
    "icustay_id": f"u * {ID_STRIDE} + k",
    "dbsource": "CASE WHEN u % 2 = 1 THEN 'carevue' ELSE 'metavision' END",
}
ADMISSION_TYPES = ("EMERGENCY", "URGENT", "ELECTIVE", "EMERGENCY")  # by hadm_id % 4
SERVICES = ("MED", "CSURG", "TSURG")  # by hadm_id % 3

# Diagnosis code of an admission's first position, first matching rule wins.
DIAGNOSIS_RULES = (
    ("subject_id % 9 = 0", "5859"),
    ("subject_id % 19 = 0", "5856"),
    ("subject_id % 23 = 0", "20300"),
    ("subject_id % 29 = 0", "042"),
    ("subject_id % 31 = 0", "1970"),
)
DIAGNOSIS_DEFAULT = "4019"
# Second position, by hadm_id % 5.
DIAGNOSIS_SECOND = ("0420", "2386", "V1000", "25000", "4280")

# Notes: subject = doc_id % (largest subject + 1); the first admission, but NULL
# for every 3rd note.

# Notes of category 'Echo' (doc_id % 4 = 0) start with a structured report
# header built from the document's own id and length, followed by the whole
# document text; other notes are the document text.  Every 10th report has a
# de-identified height, every 7th no time line.
NOTE_CATEGORY = "CASE WHEN doc_id % 4 = 0 THEN 'Echo' ELSE 'Nursing' END"
_NL = "chr(10)"
ECHO_HEADER = " || ".join([
    "'PATIENT/TEST INFORMATION:'", _NL,
    "'Indication: '",
    "CASE doc_id % 3 WHEN 0 THEN 'Chest pain' WHEN 1 THEN 'Dyspnea' ELSE 'Murmur' END", _NL,
    "'Height: (in) '",
    "CASE WHEN doc_id % 10 = 0 THEN '[**Numeric Identifier 1**]' "
    "ELSE CAST(55 + doc_id % 25 AS STRING) END", _NL,
    "'Weight (lb): '", "CAST(90 + n_chars % 200 AS STRING)", _NL,
    "'BSA (m2): 1.'", "CAST(10 + doc_id % 90 AS STRING)", "' m2'", _NL,
    "'BP (mm Hg): '", "CAST(90 + doc_id % 60 AS STRING)", "'/'",
    "CAST(50 + doc_id % 40 AS STRING)", _NL,
    "'HR (bpm): '", "CAST(55 + doc_id % 70 AS STRING)", _NL,
    "'Status: '", "CASE WHEN doc_id % 2 = 0 THEN 'Inpatient' ELSE 'Outpatient' END", _NL,
    "CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Date/Time: [**2101-1-1**] at ' || "
    "lpad(CAST(doc_id % 24 AS STRING), 2, '0') || ':' || "
    "lpad(CAST(doc_id % 60 AS STRING), 2, '0') || chr(10) END",
    "'Test: TTE (Complete)'", _NL,
    "'Doppler: Full Doppler and color Doppler'", _NL,
    "'Contrast: None'", _NL,
    "'Technical Quality: Adequate'", _NL,
])
NOTE_TEXT = f"CASE WHEN doc_id % 4 = 0 THEN {ECHO_HEADER} || text ELSE text END"
