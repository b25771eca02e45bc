"""DuckDB oracle text for the daily pressures and CVP."""

from __future__ import annotations

from stayframe.oracle import facts
from stayframe.oracle.book import US_PER_HOUR, bucket_join, table, us_between

_COLUMNS = {"peep": ("avg_peep", "max_peep", "peep_time", "peep_twm"), "pplat": ("avg_pplat", "max_pplat", "pplat_time", "pplat_twm"),
            "paw": ("avg_paw", "max_paw", "paw_time", "paw_twm"), "cvp": ("avg_cvp", "max_cvp", "cvp_time", "cvp_twm")}


def ctes() -> dict:
    items = [(name, style, int(i), valued) for name, (style, values, dated) in facts.PRESSURES.items()
             for text, valued in ((values, True), (dated, False)) for i in text.split()]
    out = {
        "pressure_rows": (("chartevents", "cohort"), f"""
    SELECT p.concept, p.style, p.valued, c.icustay_id, c.itemid, c.valuenum, c.charttime, c.row_id,
           min(c.charttime) OVER (PARTITION BY p.concept, c.icustay_id) AS origin
    FROM chartevents c SEMI JOIN cohort USING (icustay_id)
    JOIN {table('p(concept, style, itemid, valued)', items)} ON p.itemid = c.itemid"""),
        "twm_daily": (("pressure_rows", "day_buckets"), f"""
    SELECT concept, icustay_id, day, avg(valuenum) AS avg_value, max(valuenum) AS max_value,
           sum(valuenum * hours) AS value_time,
           CASE WHEN 0 IN (sum(hours), sum(valuenum * hours)) THEN max(valuenum)
                ELSE sum(valuenum * hours) / sum(hours) END AS twm
    FROM (
      SELECT r.*, b.day,
             {us_between('lag(r.charttime) OVER (PARTITION BY r.concept, r.icustay_id ORDER BY r.charttime, r.row_id)',
                         'r.charttime')} // {US_PER_HOUR} % 24 AS hours
      FROM pressure_rows r
      {bucket_join('b', 'r.style', us_between('r.origin', 'r.charttime'), 'LEFT JOIN')}
      WHERE r.valued) weighted
    GROUP BY concept, icustay_id, day, itemid"""),
    }
    for name, (a, m, t, w) in _COLUMNS.items():
        out[f"table_{name}"] = (("twm_daily",), f"""
    SELECT icustay_id, day, avg_value AS {a}, max_value AS {m}, value_time AS {t}, twm AS {w}
    FROM twm_daily WHERE concept = '{name}'""")
    out["respi_integration"] = (("table_peep", "table_pplat", "table_paw"), """
    SELECT days.icustay_id, days.day, p.* EXCLUDE (icustay_id, day), l.* EXCLUDE (icustay_id, day),
           w.* EXCLUDE (icustay_id, day)
    FROM (SELECT icustay_id, day FROM table_peep UNION SELECT icustay_id, day FROM table_pplat
          UNION SELECT icustay_id, day FROM table_paw) days
    LEFT JOIN table_peep p USING (icustay_id, day) LEFT JOIN table_pplat l USING (icustay_id, day)
    LEFT JOIN table_paw w USING (icustay_id, day)
    WHERE days.day IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY days.icustay_id) > 2""")
    return out
