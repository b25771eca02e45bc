"""DuckDB oracle text for the day spine and the final wide table."""

from __future__ import annotations

from stayframe.oracle import facts

_SOFA_NAMES = {"respiration": "sofa_respi", "coagulation": "sofa_coag", "liver": "sofa_liver",
               "cardiovascular": "sofa_cv", "cns": "sofa_neuro", "renal": "sofa_renal"}


def ctes() -> dict:
    drugs = ", ".join(f"max(flag) FILTER (drug = '{d}') AS {d}" for d in facts.DRUGS)
    daily = ("hemodyn_daily", "drug_days", "table_peep", "table_paw", "table_pplat", "creat_daily", "urine_days",
             "rrt_daily", "kdigo_days", "vent_day_flags")
    return {
        "day_spine": (("cohort",), """
    SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS day, icustay_id FROM cohort"""),
        "drug_days": (("vasopressor_daily",), f"""
    SELECT icustay_id, day, {drugs} FROM vasopressor_daily GROUP BY icustay_id, day"""),
        "urine_days": (("urine_pivot",), "SELECT * RENAME (day_24h AS day) FROM urine_pivot"),
        "kdigo_days": (("kdigo_daily",), "SELECT icustay_id, day_24h AS day, max_kdigo_24h FROM kdigo_daily"),
        "stay_scores": (("sofa", "sapsii", "apsiii"), f"""
    SELECT o.icustay_id, o.sofa, {', '.join(f'o.{k} AS {v}' for k, v in _SOFA_NAMES.items())}, s.sapsii, a.apsiii
    FROM sofa o FULL JOIN sapsii s USING (icustay_id) FULL JOIN apsiii a USING (icustay_id)"""),
        "global_merge": (("day_spine", "cohort", "cohort_episodes", "stay_scores", *daily), f"""
    SELECT *
    FROM day_spine JOIN cohort USING (icustay_id) LEFT JOIN stay_scores USING (icustay_id)
    {' '.join(f'LEFT JOIN {t} USING (icustay_id, day)' for t in daily)}
    WHERE EXISTS (FROM cohort_episodes e WHERE e.icustay_id = day_spine.icustay_id)"""),
    }
