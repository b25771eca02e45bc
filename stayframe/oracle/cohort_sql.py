"""DuckDB oracle text for the cohort concepts."""

from __future__ import annotations

from stayframe.functions.numeric import numeric_round_sql as nround
from stayframe.oracle import facts
from stayframe.oracle.book import us_between

_US_PER_DAY = 86_400_000_000


def _days(start: str, end: str, per: float = 1) -> str:
    return nround(f"CAST({us_between(start, end)} AS DOUBLE) / {_US_PER_DAY} / {per}", 4)


def _line(label: str) -> str:
    """The rest of the line behind a label, NULL where the label is missing."""
    return f"CASE WHEN contains(text, '{label}') THEN split_part(split_part(text, '{label}', 2), chr(10), 1) END"


def _number(x: str) -> str:
    return f"CASE WHEN NOT contains({x}, '*') THEN TRY_CAST({x} AS DOUBLE) END"


def _echo() -> str:
    lines = {"indication": "Indication: ", "height": "Height: (in) ", "weight": "Weight (lb): ", "bsa": "BSA (m2): ",
             "bp": "BP (mm Hg): ", "hr": "HR (bpm): ", "status": "Status: ", "test": "Test: ", "doppler": "Doppler: ",
             "contrast": "Contrast: ", "technicalquality": "Technical Quality: ", "stamp": "Date/Time: "}
    texts = ("indication", "bp", "status", "test", "doppler", "contrast", "technicalquality")
    return f"""
    SELECT row_id, subject_id, hadm_id, chartdate,
           CAST(TRY_CAST(CAST(chartdate AS VARCHAR) || ' ' || split_part(stamp, ' at ', 2) || ':00' AS TIMESTAMP)
                AS TIMESTAMP) AS charttime,
           {', '.join(texts)},
           {_number('height')} AS height, {_number('weight')} AS weight, {_number('hr')} AS hr,
           {_number("replace(bsa, ' m2', '')")} AS bsa,
           {_number("split_part(bp, '/', 1)")} AS bpsys, {_number("split_part(bp, '/', 2)")} AS bpdias
    FROM (SELECT row_id, subject_id, hadm_id, chartdate, {', '.join(f'{_line(v)} AS {k}' for k, v in lines.items())}
          FROM noteevents WHERE category = 'Echo') fields"""


def weight_ctes(prefix: str, stays: str) -> dict:
    """First-day weight of the stays in CTE ``stays``: four sources in one long table, the best source wins."""
    around = "c.charttime > ie.intime - INTERVAL 1 DAY AND c.charttime <= ie.intime + INTERVAL 1 DAY"
    return {
        f"{prefix}_votes": ((stays, "chartevents", "icustays", "echo_data"), f"""
    SELECT c.icustay_id, CASE WHEN c.itemid IN (762, 226512) THEN 1 ELSE 2 END AS source, c.valuenum AS kg
    FROM icustays ie JOIN chartevents c USING (icustay_id)
    WHERE c.itemid IN (762, 226512, 763, 224639) AND c.valuenum <> 0 AND coalesce(c.error, 0) <> 1 AND {around}
    UNION ALL
    SELECT ie.icustay_id, 3, e.weight FROM echo_data e JOIN icustays ie USING (hadm_id)
    WHERE e.charttime < ie.intime + INTERVAL 1 DAY AND e.weight IS NOT NULL
    UNION ALL
    SELECT ie.icustay_id, 4, e.weight FROM icustays ie JOIN echo_data e USING (subject_id)
    WHERE e.hadm_id IS NULL AND e.weight IS NOT NULL
      AND e.charttime < ie.intime AND e.charttime + INTERVAL 1 MONTH > ie.intime"""),
        f"{prefix}_sources": ((f"{prefix}_votes",), f"""
    SELECT icustay_id, source, median(kg) * CASE WHEN source > 2 THEN {facts.LB_KG} ELSE 1.0 END AS kg
    FROM {prefix}_votes GROUP BY icustay_id, source"""),
        prefix: ((stays, f"{prefix}_sources"), f"""
    SELECT s.subject_id, s.icustay_id, {nround('arg_min(w.kg, w.source)', 2)} AS weight,
           max(w.kg) FILTER (w.source = 1) AS weight_admit, max(w.kg) FILTER (w.source = 2) AS weight_daily,
           max(w.kg) FILTER (w.source = 3) AS weight_echoinhosp, max(w.kg) FILTER (w.source = 4) AS weight_echoprehosp
    FROM {stays} s LEFT JOIN {prefix}_sources w USING (icustay_id)
    GROUP BY s.subject_id, s.icustay_id"""),
    }


def ctes() -> dict:
    out = {
        # stays of admissions with charted data, all facts side by side
        "stay_facts": (("icustays", "admissions", "patients"), """
    SELECT i.*, a.* EXCLUDE (subject_id, hadm_id, has_chartevents_data), p.gender, p.dob
    FROM admissions a JOIN icustays i USING (hadm_id) JOIN patients p ON p.subject_id = i.subject_id
    WHERE a.has_chartevents_data = 1"""),
        # ranks by counting what comes before
        "demographics": (("stay_facts",), f"""
    SELECT s.subject_id, s.hadm_id, s.icustay_id, s.gender, s.ethnicity, s.admission_type, s.admittime, s.dischtime,
           if(s.deathtime IS NULL, 'N', 'Y') AS hospital_expire_flag,
           if(coalesce(s.deathtime <= s.outtime, FALSE)
              OR (s.dischtime <= s.outtime AND s.discharge_location = 'DEAD/EXPIRED'), 'Y', 'N') AS icu_expire_flag,
           CAST(h.earlier AS INTEGER) AS hospstay_seq, if(h.earlier = 1, 'Y', 'N') AS first_hosp_stay,
           s.intime, s.outtime, {_days('s.dob', 's.intime', 365.242)} AS age, {_days('s.intime', 's.outtime')} AS los_icu,
           CAST(k.earlier AS INTEGER) AS icustay_seq, if(s.intime = k.first_in, 'Y', 'N') AS first_icu_stay
    FROM stay_facts s
    JOIN (SELECT a.icustay_id, count(DISTINCT b.admittime) AS earlier
          FROM stay_facts a JOIN stay_facts b ON a.subject_id = b.subject_id AND b.admittime <= a.admittime
          GROUP BY a.icustay_id) h ON h.icustay_id = s.icustay_id
    JOIN (SELECT a.icustay_id, min(b.intime) AS first_in,
                 count(*) FILTER ((b.intime, b.icustay_id) <= (a.intime, a.icustay_id)) AS earlier
          FROM stay_facts a JOIN stay_facts b ON a.hadm_id = b.hadm_id
          GROUP BY a.icustay_id, a.intime) k ON k.icustay_id = s.icustay_id"""),
        "cohort_select": (("demographics",), """
    FROM demographics SELECT *
    WHERE first_icu_stay = 'Y' AND list_contains(['EMERGENCY', 'URGENT'], admission_type) AND age >= 18"""),
        "echo_data": (("noteevents",), _echo()),
        "cohort": (("cohort_select", "weight_first_day", "diagnoses_icd"), """
    SELECT c.*, w.weight
    FROM cohort_select c
    JOIN weight_first_day w USING (icustay_id)
    ANTI JOIN (SELECT subject_id FROM diagnoses_icd WHERE icd9_code = '5859') ckd ON ckd.subject_id = c.subject_id"""),
    }
    out.update(weight_ctes("weight_first_day", "cohort_select"))
    return out
