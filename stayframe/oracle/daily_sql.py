"""DuckDB oracle text for liver enzymes (C16) and vasopressors (C17)."""

from __future__ import annotations

from stayframe.oracle import facts
from stayframe.oracle.book import bucket_join, table, us_between


def _named(spec: dict) -> str:
    return table("n(name, style, itemid)",
                 [(name, style, int(i)) for name, (style, text) in spec.items() for i in text.split()])


def ctes() -> dict:
    return {
        "enzyme_daily_max": (("chartevents", "cohort", "cohort_episodes", "day_buckets"), f"""
    SELECT n.name AS enzyme, c.icustay_id, b.day, max(e.valuenum) AS max_value
    FROM {_named(facts.ENZYMES)}
    JOIN chartevents e ON e.itemid = n.itemid
    JOIN cohort c ON c.icustay_id = e.icustay_id
    {bucket_join('b', 'n.style', us_between('c.admittime', 'e.charttime'))}
    WHERE n.name = 'bili' OR c.icustay_id IN (FROM cohort_episodes SELECT icustay_id)
    GROUP BY n.name, c.icustay_id, b.day, n.itemid"""),
        "vasopressor_daily": (("inputevents_cv", "cohort", "day_buckets"), f"""
    SELECT DISTINCT n.name AS drug, c.icustay_id, b.day, 1 AS flag
    FROM inputevents_cv e JOIN {_named(facts.DRUGS)} USING (itemid) JOIN cohort c USING (icustay_id)
    {bucket_join('b', 'n.style', us_between('c.admittime', 'e.charttime'))}"""),
    }
