"""Query keys -> concept builders and their DuckDB oracles."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayframe.oracle import (cohort_sql, daily_sql, final_sql, firstday_sql, fixture_sql,
                              generic_sql,
                              hemodynamics_sql, renal_sql, respiratory_sql, severity_sql,
                              ventilation_sql)
from stayframe.oracle.book import SqlBook
from stayframe.plans import (cohort, daily, final, firstday, generic,  # noqa: F401
                             hemodynamics, renal, respiratory, severity, sinks, ventilation)
from stayframe.plans.base import Concepts, oracle_select
from stayframe.plans.pipeline import display
from stayframe.sources.fixture import Tables
from stayframe.sources.snapshot import input_fingerprint

# key -> concept whose output the key returns.
QUERY_KEYS: dict[str, str] = {
    "stay_demographics": "demographics",
    "cohort_select": "cohort_select",
    "note_fields": "echo_data",
    "weight_first_day": "weight_first_day",
    "exclude_diagnosis": "cohort",
    "vent_settings": "vent_settings",
    "vent_newevent": "vent_newevent",
    "vent_durations": "vent_durations",
    "cohort_episodes": "cohort_episodes",
    "vent_day_flags": "vent_day_flags",
    "twm_daily": "twm_daily",
    "respi_integration": "respi_integration",
    "mpp_nearest": "mpp_nearest",
    "hemodyn_daily": "hemodyn_daily",
    "enzyme_daily_max": "enzyme_daily_max",
    "vasopressor_daily": "vasopressor_daily",
    "creat_daily": "creat_daily",
    "rrt_daily": "rrt_daily",
    "urine_binned": "urine_binned",
    "urine_pivot": "urine_pivot",
    "kdigo_stage": "kdigo_stage",
    "kdigo_daily": "kdigo_daily",
    "vitals_first_day": "vitals_first_day",
    "labs_first_day": "labs_first_day",
    "blood_gas_pivot": "blood_gas_pivot",
    "asof_spo2": "asof_spo2",
    "asof_fio2": "asof_fio2",
    "blood_gas_arterial": "blood_gas_arterial",
    "gcs_min": "gcs_min",
    "urine_first_day": "urine_first_day",
    "vent_first_day": "vent_first_day",
    "height_first_day": "height_first_day",
    "weight_first_day_all": "weight_first_day_all",
    "rrt_first_day": "rrt_first_day",
    "gas_on_vent": "gas_on_vent",
    "device_flag": "device_flag",
    "service_flag": "service_flag",
    "comorbidity_flags": "comorbidity_flags",
    "sofa": "sofa",
    "sapsii": "sapsii",
    "aps_gas_pick": "aps_gas_pick",
    "apsiii": "apsiii",
    "sirs": "sirs",
    "severity_attach": "severity_attach",
    "day_spine": "day_spine",
    "global_merge": "global_merge",
    "valid_rows": "valid_rows",
    "cohort_semi": "cohort_semi",
    "item_map_filter": "item_map_filter",
    "plausibility_clean": "plausibility_clean",
    "unit_normalise": "unit_normalise",
    "first_per_group": "first_per_group",
    "first_day_window": "first_day_window",
    "weight_echo_prehosp": "weight_echo_prehosp",
    "labelled_items": "labelled_items",
    "saved_overwrite": "saved_overwrite",
    "saved_once": "saved_once",
    "bulk_drop": "bulk_drop",
    "saved_after_failure": "saved_after_failure",
    "search_path_read": "search_path_read",
    "snapshot_refresh": "snapshot_refresh",
    "severity_display": "severity_display",
}

# Keys whose result is shown in an order (O3).
DISPLAY_ORDER = {"severity_display": ("icustay_id", "starttime")}

ORACLE_MODULES = (cohort_sql, ventilation_sql, respiratory_sql, hemodynamics_sql, daily_sql,
                  renal_sql, firstday_sql, severity_sql, final_sql, generic_sql)

# Keys without a DuckDB oracle (none so far).
NO_ORACLE: set[str] = set()


def book() -> SqlBook:
    b = SqlBook()
    b.update(fixture_sql.fixture_ctes())
    for mod in ORACLE_MODULES:
        b.update(mod.ctes())
    return b


# One concept graph per (Spark application, input directory, its files): concepts
# stored by an earlier query are read by later ones instead of being rebuilt, as the
# stored tables of a pipeline run are, until a file of the directory changes.
_GRAPHS: dict[tuple[str, str, str], Concepts] = {}
_GRAPHS_LOCK = threading.Lock()


def concepts_for(spark: SparkSession, sf_dir: str) -> Concepts:
    app = spark.conf.get("spark.app.id", None) or str(id(spark))
    k = (app, sf_dir.rstrip("/"), input_fingerprint(spark, [sf_dir]))
    with _GRAPHS_LOCK:
        if k not in _GRAPHS:
            _GRAPHS[k] = Concepts(Tables(spark, sf_dir))
        return _GRAPHS[k]


def forget(sf_dir: str) -> None:
    """Drop the stored graphs of a directory, those of its earlier files included."""
    with _GRAPHS_LOCK:
        for k in [k for k in _GRAPHS if k[1] == sf_dir.rstrip("/")]:
            _GRAPHS.pop(k).release()


def run(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    out = concepts_for(spark, sf_dir).output(QUERY_KEYS[key])
    return display(out, *DISPLAY_ORDER[key]) if key in DISPLAY_ORDER else out


def query_fns() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, _k=k: run(spark, sf_dir, _k)) for k in QUERY_KEYS}


def oracle_sqls() -> dict[str, str]:
    b = book()
    out = {}
    for key, name in QUERY_KEYS.items():
        if key in NO_ORACLE:
            continue
        out[key] = b.sql(oracle_select(name, name), [name])
    return out
