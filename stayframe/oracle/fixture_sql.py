"""DuckDB text of the derived clinical tables, as named CTE bodies.

Built from the same recipe as the Spark side (``sources.fixture_spec``), but
formulated independently: stays are found with a range *join* here, with a
closed-form lookup on the Spark side, so a mistake in either shows up as a
row-count mismatch in the oracle check.
"""

from __future__ import annotations

from stayframe.oracle.book import day_buckets
from stayframe.sources import fixture_spec as spec

_TS0 = f"TIMESTAMP '{spec.EPOCH}'"


def _icustays() -> str:
    return f"""
    SELECT u AS subject_id,
           {spec.STAY_RULES['hadm_id']} AS hadm_id,
           {spec.STAY_RULES['icustay_id']} AS icustay_id,
           origin + to_days(CAST({spec.STAY_SPACING_DAYS} * k AS INTEGER)) AS intime,
           origin + to_days(CAST({spec.STAY_SPACING_DAYS} * k AS INTEGER))
                  + to_days(CAST(3 + (u * {spec.ID_STRIDE} + k) % 6 AS INTEGER)) AS outtime,
           {spec.STAY_RULES['dbsource']} AS dbsource
    FROM (SELECT u, origin, unnest(generate_series(0, greatest(0, (epoch_us(last_ts) - epoch_us(origin))
                 // ({spec.STAY_SPACING_DAYS} * 86400000000)))) AS k
          FROM (SELECT user_id AS u, max(ts) AS last_ts,
                       {_TS0} + to_hours(CAST(user_id % 24 AS INTEGER)) AS origin
                FROM events GROUP BY user_id) s) kk"""


def _patient_events() -> str:
    return """
    SELECT e.event_id, e.event_type, e.value, e.user_id AS subject_id, s.hadm_id, s.icustay_id,
           date_trunc('second', e.ts) AS charttime
    FROM events e
    LEFT JOIN icustays s ON e.user_id = s.subject_id AND e.ts BETWEEN s.intime AND s.outtime"""


def _event_table(table: str) -> str:
    parts = []
    for role in spec.ROLES:
        if role.table != table:
            continue
        no = spec.ROLE_NO[role.name]
        for j, row in enumerate(role.rows):
            parts.append(f"""
        SELECT event_id * 100 + {no * 10 + j} AS row_id, event_id, subject_id, hadm_id,
               icustay_id, charttime,
               CAST({row.itemid} AS BIGINT) AS itemid,
               CAST({row.value} AS VARCHAR) AS r_value,
               CAST({row.valuenum} AS DOUBLE) AS r_valuenum
        FROM patient_events WHERE {role.where}""")
    union = "\n        UNION ALL".join(parts)
    sources = spec.COLUMN_SOURCES[table]
    cols = []
    for c in spec.EVENT_TABLE_COLUMNS[table]:
        expr = sources.get(c, c)
        if c == "error":
            expr = f"CAST({expr} AS INTEGER)"
        cols.append(f"{expr} AS {c}")
    return f"""
    SELECT {', '.join(cols)}
    FROM (SELECT row_id, event_id, subject_id, hadm_id, icustay_id, charttime, itemid,
                 r_value AS value, r_valuenum AS valuenum
          FROM ({union}) x) y"""


def _admissions() -> str:
    types = spec.ADMISSION_TYPES
    return f"""
    SELECT subject_id, hadm_id, admittime, dischtime, deathtime,
           CASE WHEN deathtime IS NOT NULL THEN 'DEAD/EXPIRED' ELSE 'HOME' END
             AS discharge_location,
           CASE hadm_id % 4 WHEN 0 THEN '{types[0]}' WHEN 1 THEN '{types[1]}'
                            WHEN 2 THEN '{types[2]}' ELSE '{types[3]}' END AS admission_type,
           CASE WHEN subject_id % 5 = 0 THEN 'BLACK/AFRICAN AMERICAN'
                WHEN subject_id % 7 = 0 THEN NULL ELSE 'WHITE' END AS ethnicity,
           CASE WHEN hadm_id % 13 = 0 THEN 0 ELSE 1 END AS has_chartevents_data
    FROM (
      SELECT subject_id, hadm_id,
             min(intime) - INTERVAL 6 HOUR AS admittime,
             max(outtime) + INTERVAL 12 HOUR AS dischtime,
             CASE WHEN hadm_id % 7 = 0 THEN max(outtime) - INTERVAL 1 HOUR
                  WHEN hadm_id % 11 = 0 THEN max(outtime) + INTERVAL 6 HOUR END AS deathtime
      FROM icustays GROUP BY subject_id, hadm_id) a"""


def _patients() -> str:
    return f"""
    SELECT u AS subject_id,
           CASE WHEN u % 17 = 0 THEN NULL WHEN u % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           {_TS0} - to_days(CAST((10 + u % 80) * 365 AS INTEGER)) AS dob
    FROM (SELECT DISTINCT user_id AS u FROM events) s"""


def _diagnoses() -> str:
    arms = " ".join(f"WHEN {c} THEN '{code}'" for c, code in spec.DIAGNOSIS_RULES)
    second = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(spec.DIAGNOSIS_SECOND))
    return f"""
    SELECT subject_id, hadm_id, CAST(1 AS BIGINT) AS seq_num,
           CASE {arms} ELSE '{spec.DIAGNOSIS_DEFAULT}' END AS icd9_code
    FROM admissions
    UNION ALL
    SELECT subject_id, hadm_id, CAST(2 AS BIGINT) AS seq_num,
           CASE hadm_id % 5 {second} END AS icd9_code
    FROM admissions"""


def _services() -> str:
    s = spec.SERVICES
    return f"""
    SELECT hadm_id, CASE hadm_id % 3 WHEN 0 THEN '{s[0]}' WHEN 1 THEN '{s[1]}'
                    ELSE '{s[2]}' END AS curr_service, admittime AS transfertime
    FROM admissions
    UNION ALL
    SELECT hadm_id, 'MED' AS curr_service, admittime + INTERVAL 1 HOUR AS transfertime
    FROM admissions"""


def _noteevents() -> str:
    subject = "doc_id % (SELECT max(user_id) + 1 FROM events)"
    return f"""
    SELECT doc_id AS row_id, {subject} AS subject_id,
           CASE WHEN doc_id % 3 = 0 THEN NULL ELSE ({subject}) * {spec.ID_STRIDE} END AS hadm_id,
           DATE '{spec.EPOCH[:10]}' + CAST(doc_id % 30 AS INTEGER) AS chartdate,
           {spec.NOTE_CATEGORY} AS category,
           {spec.NOTE_TEXT} AS text
    FROM documents"""


def fixture_ctes() -> dict[str, tuple[tuple[str, ...], str]]:
    """name -> (dependencies, body)."""
    ctes: dict[str, tuple[tuple[str, ...], str]] = {
        "day_buckets": ((), day_buckets()),
        "icustays": ((), _icustays()),
        "patient_events": (("icustays",), _patient_events()),
        "admissions": (("icustays",), _admissions()),
        "patients": ((), _patients()),
        "diagnoses_icd": (("admissions",), _diagnoses()),
        "services": (("admissions",), _services()),
        "noteevents": ((), _noteevents()),
    }
    for table in spec.EVENT_TABLE_COLUMNS:
        ctes[table] = (("patient_events",), _event_table(table))
    ctes["d_items"] = (("chartevents",), """
    SELECT DISTINCT itemid, 'item ' || CAST(itemid AS VARCHAR) AS label
    FROM chartevents""")
    return ctes
