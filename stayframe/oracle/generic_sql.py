"""DuckDB oracle text for the single-operator queries."""

from __future__ import annotations

from stayframe.oracle import facts
from stayframe.oracle.book import ids, table


def ctes() -> dict:
    vitals = table("v(itemid, label)", sorted({(int(i), name) for name, text, *_ in facts.VITALS for i in text.split()}))
    limits = table("l(itemid, top)", [(int(i), top) for top, text in facts.LABS.values() for i in text.split()])
    in_cm = [(int(i), "cm", facts.IN_CM, 0.0) for i in facts.HEIGHT_IN.split()]
    units = table("u(itemid, unit, factor, zero)", [
        (3581, "kg", facts.LB_KG_EXACT, 0.0), (3582, "kg", facts.OZ_KG, 0.0), *in_cm,
        *[(i, "degC", 1 / 1.8, 32.0) for i in (678, 223761)],
        *[(int(i), "umol/L", float(facts.CREAT_UMOL), 0.0) for i in facts.CREATININE.split()]])
    dropped = ("vitals_first_day", "labs_first_day", "gcs_min", "urine_first_day")
    return {
        "saved_overwrite": (("cohort",), "SELECT * FROM cohort"),
        "saved_once": (("echo_data",), "SELECT * FROM echo_data"),
        "severity_display": (("severity_attach",), "SELECT * FROM severity_attach"),
        "bulk_drop": (dropped, " UNION ALL ".join(
            f"SELECT '{n}' AS concept, count(*) AS n_rows, FALSE AS left_over FROM {n}" for n in dropped)),
        "saved_after_failure": (("cohort",), "SELECT * FROM cohort"),
        "search_path_read": (("icustays", "admissions", "cohort"), """
    SELECT i.icustay_id, i.hadm_id, a.admission_type, 'results' AS stays_from, 'source' AS admissions_from
    FROM admissions a JOIN icustays i USING (hadm_id) SEMI JOIN cohort c ON c.icustay_id = i.icustay_id"""),
        "snapshot_refresh": (("comorbidity_flags",), "SELECT *, 2 AS n_built FROM comorbidity_flags"),
        "labelled_items": (("chartevents",), """
    SELECT itemid, 'item ' || itemid AS label, count(*) AS n_rows FROM chartevents GROUP BY itemid"""),
        "valid_rows": (("chartevents",), """
    SELECT itemid, count(*) AS n_rows, count(*) FILTER (coalesce(error, 0) <> 1) AS n_valid,
           count(*) FILTER (error = 1) AS n_error, count(*) - count(error) AS n_null_error
    FROM chartevents GROUP BY ALL"""),
        "cohort_semi": (("chartevents", "cohort"), """
    SELECT e.icustay_id, e.itemid, count(*) AS n_rows, min(e.charttime) AS first_time, max(e.charttime) AS last_time
    FROM cohort c JOIN chartevents e USING (icustay_id) GROUP BY ALL"""),
        "item_map_filter": (("chartevents",), f"""
    SELECT e.row_id, e.icustay_id, e.itemid, e.charttime, v.label, e.valuenum FROM chartevents e JOIN {vitals} USING (itemid)"""),
        "plausibility_clean": (("labevents",), f"""
    SELECT e.*, if(e.valuenum > l.top OR (e.itemid = 51144 AND e.valuenum < 0), NULL, e.valuenum) AS clean_value
    FROM labevents e JOIN {limits} USING (itemid)"""),
        "unit_normalise": (("chartevents", "labevents"), f"""
    SELECT e.row_id, e.itemid, e.valuenum, u.unit, (e.valuenum - u.zero) * u.factor AS normalised
    FROM (SELECT row_id, itemid, valuenum FROM chartevents UNION ALL SELECT row_id, itemid, valuenum FROM labevents) e
    JOIN {units} USING (itemid)"""),
        "first_per_group": (("chartevents",), """
    SELECT DISTINCT ON (icustay_id, itemid) icustay_id, itemid, charttime, valuenum
    FROM chartevents ORDER BY icustay_id, itemid, charttime, row_id"""),
        "first_day_window": (("chartevents", "icustays"), """
    SELECT e.icustay_id, e.itemid, count(*) AS n_rows, min(e.valuenum) AS min_value, max(e.valuenum) AS max_value
    FROM icustays i JOIN chartevents e USING (icustay_id)
    WHERE e.charttime >= i.intime AND e.charttime <= i.intime + INTERVAL 24 HOUR
    GROUP BY ALL"""),
        "weight_echo_prehosp": (("weight_first_day_all_sources",), """
    SELECT icustay_id, kg AS weight_echoprehosp FROM weight_first_day_all_sources WHERE source = 4"""),
    }
