"""Concept registry: named, lazily built DataFrames over one set of tables.

A concept is a function ``(Concepts) -> DataFrame``.  ``Concepts.get`` builds a
concept once per instance; concepts with several readers (``SHARED``) are
stored once and read back, the rest stay lazy and become part of their
readers' plans.  Output columns and types of a concept are declared in
``SCHEMAS`` so the Spark result and its DuckDB oracle agree column by column.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.functions.numeric import numeric_round, numeric_round_sql
from stayframe.sources.fixture import Tables
from stayframe.sources.staging import forget_tables, remove, run_folder, stage, stage_by_key

BUILDERS: dict[str, Callable[["Concepts"], DataFrame]] = {}
SCHEMAS: dict[str, list[tuple[str, str]]] = {}

# Concepts read by several later concepts.  They are stored once as parquet in
# the shared checkpoint folder (``sources.staging``): later plans start from
# the stored rows instead of re-deriving them, plans stay small enough to
# analyse quickly, and a lost executor re-reads files instead of recomputing
# the whole chain (the analytics being rebuilt store every step as a table, too).
SHARED = {
    "demographics", "cohort_select", "weight_first_day", "gas_on_vent",
    "cohort", "echo_data", "vent_durations", "cohort_episodes", "twm_daily", "urine_binned",
    "blood_gas_arterial", "vitals_first_day", "labs_first_day", "urine_first_day", "gcs_min",
    "vent_first_day", "sofa", "sapsii", "apsiii", "hemodyn_daily", "vasopressor_daily",
    "kdigo_daily", "urine_pivot", "creat_daily", "rrt_daily", "vent_day_flags",
    "vent_newevent", "mpp_nearest", "vent_settings", "stay_admission", "stay_features",
}

# Shared concepts with a bounded number of rows per stay, or per stay and day 1..7, are
# stored bucketed by that key, all in equally many buckets, so the score and merge joins
# need no exchange.  Episodes and gases are not among them: a stay may hold a third of
# those, and a bucket is read by one task.
STAY = "icustay_id"
STAY_DAY = (STAY, "day")
BY_KEY = {
    **dict.fromkeys(("cohort", "stay_admission", "stay_features", "vitals_first_day",
                     "labs_first_day", "urine_first_day", "gcs_min", "vent_first_day", "sofa",
                     "sapsii", "apsiii"), (STAY,)),
    **dict.fromkeys(("hemodyn_daily", "vasopressor_daily", "twm_daily", "creat_daily",
                     "rrt_daily"), STAY_DAY),
    **dict.fromkeys(("urine_pivot", "kdigo_daily"), (STAY, "day_24h")),
}
# Stays a bucket holds at most, and at least unless that leaves cores idle.
BUCKET_STAYS = (250_000, 1_000)

ROUND_DIGITS = 6


def concept(name: str, schema: list[tuple[str, str]] | str | None = None):
    """Register a builder; ``schema`` is "col type, col type, ..." or a list."""

    def wrap(fn: Callable[["Concepts"], DataFrame]):
        BUILDERS[name] = fn
        if schema is not None:
            SCHEMAS[name] = parse_schema(schema) if isinstance(schema, str) else schema
        return fn

    return wrap


def parse_schema(text: str) -> list[tuple[str, str]]:
    out = []
    for part in text.split(","):
        part = part.strip()
        if part:
            name, typ = part.split()
            out.append((name, typ))
    return out


class Concepts:
    def __init__(self, tables: Tables, materialize: bool = True,
                 plan_log: dict[str, str] | None = None):
        self.t = tables
        self.materialize = materialize
        self.plan_log = plan_log  # name -> physical plan text, for plan checks
        self._memo: dict[str, DataFrame] = {}
        self._buckets: int | None = None
        self._lock = threading.RLock()  # callers may build concepts from several threads

    def get(self, name: str) -> DataFrame:
        with self._lock:
            return self._get(name)

    def _get(self, name: str) -> DataFrame:
        if name not in self._memo:
            df = BUILDERS[name](self)
            if self.plan_log is not None:
                self.plan_log[name] = df._jdf.queryExecution().executedPlan().toString()
            if self.materialize and name in BY_KEY:
                df = stage_by_key(self.t.spark, df, name, self.t.run_id, BY_KEY[name], self.buckets())
            elif self.materialize and name in SHARED:
                df = stage(self.t.spark, df, name, self.t.run_id)
            self._memo[name] = df
        return self._memo[name]

    def release(self) -> None:
        """Delete what this graph has stored; its DataFrames cannot be read afterwards."""
        with self._lock:
            self._memo.clear()
            forget_tables(self.t.spark, self.t.run_id)
            remove(self.t.spark, run_folder(self.t.spark, self.t.run_id))

    def buckets(self) -> int:
        """Buckets of the stay-keyed tables, from the number of stays: as many as cores while
        each holds a thousand stays, and never more than 250 000 stays in one."""
        if self._buckets is None:
            most, least = BUCKET_STAYS
            stays = self.t.icustays.count()
            cores = self.t.spark.sparkContext.defaultParallelism
            self._buckets = max(1, min(cores, stays // least), -(-stays // most))
        return self._buckets

    def aligned(self, df: DataFrame, *key: str) -> DataFrame:
        """Rows in the partitioning of the tables that are stored bucketed by ``key``."""
        return df.repartition(self.buckets(), *key) if self.materialize else df

    def stay_join(self, df: DataFrame, *parts: DataFrame) -> DataFrame:
        """Left joins of tables stored in buckets of the stay, bucket by bucket: nothing is
        exchanged, and nothing sent through the driver, whatever their sizes."""
        for p in parts:
            df = df.join(p.hint("merge"), STAY, "left")
        return df

    def stay_row(self, *parts: DataFrame) -> DataFrame:
        """One row a stay with the columns of every part (each one row a stay, other columns
        distinct).  The parts are stacked and folded after one exchange in the stored
        tables' partitioning, which the bucketed write and the grouping share."""
        stacked = parts[0]
        for p in parts[1:]:
            stacked = stacked.unionByName(p, allowMissingColumns=True)
        stacked = self.aligned(stacked, STAY)
        values = [n for n in stacked.columns if n != STAY]
        if not values:
            return stacked.dropDuplicates([STAY])
        return stacked.groupBy(STAY).agg(*[F.max(n).alias(n) for n in values])

    def intermediate(self, df: DataFrame, name: str) -> DataFrame:
        """Store a multi-pass operator's intermediate rows once (when materializing)."""
        if not self.materialize:
            return df
        if self.plan_log is not None:
            self.plan_log[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(self.t.spark, df, f"{name}_{len(self._memo)}", self.t.run_id)

    def keep(self, name: str):
        """``intermediate`` under a name, for operators that store rows themselves; None (their own folder) when not materializing."""
        return (lambda df: self.intermediate(df, name)) if self.materialize else None

    def output(self, name: str) -> DataFrame:
        """The concept in its declared column order and types, doubles rounded to
        6 decimals the way a decimal rounds (``functions.numeric``), identically
        in Spark and in the oracle."""
        return shape(self.get(name), SCHEMAS[name])


def shape(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for name, typ in schema:
        c = F.col(name).cast(typ)
        if typ == "double":
            c = numeric_round(c, ROUND_DIGITS)
        cols.append(c.alias(name))
    return df.select(*cols)


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
               "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def oracle_select(name: str, source: str) -> str:
    """Final SELECT of an oracle query, mirroring ``shape``."""
    cols = []
    for col, typ in SCHEMAS[name]:
        expr = f"CAST({col} AS {_DUCK_TYPES[typ]})"
        if typ == "double":
            expr = numeric_round_sql(expr, ROUND_DIGITS)
        cols.append(f"{expr} AS {col}")
    return f"SELECT {', '.join(cols)} FROM {source}"
