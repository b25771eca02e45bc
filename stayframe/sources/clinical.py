"""Stored clinical tables as the source (S1): parquet files or catalog tables.

``Tables`` derives the clinical tables from the driver's generic tables (the
test data); on a real deployment the clinical tables already exist and are
read directly -- no derivation, no copy.  ``ClinicalTables`` offers the same
attributes, so every concept runs unchanged on either source:

    c = Concepts(ClinicalTables(spark, root="s3://bucket/icu/"))   # parquet per table
    c = Concepts(ClinicalTables(spark, database="icu"))            # catalog tables
    c = Concepts(ClinicalTables(spark, schemas=["s3://bucket/results/", "icu"]))  # search path

A search path is an ordered list of folders and catalog databases: a table is read
from the first that has it, so stored results go before the source tables.  A folder
has a table as parquet or as a published result (``sources.published``).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from stayframe.sources.published import is_published, read_published
from stayframe.sources.staging import exists, new_run_id

log = logging.getLogger(__name__)

CLINICAL_TABLES = (
    "patients", "admissions", "icustays", "chartevents", "labevents", "outputevents",
    "inputevents_cv", "inputevents_mv", "procedureevents_mv", "datetimeevents",
    "diagnoses_icd", "services", "d_items", "noteevents",
)


class ClinicalTables:
    def __init__(self, spark: SparkSession, root: str | None = None,
                 database: str | None = None, schemas: list[str] | None = None):
        if sum(x is not None for x in (root, database, schemas)) != 1:
            raise ValueError("give exactly one of root=, database= or schemas=")
        self.spark = spark
        self.schemas = [s.rstrip("/") for s in schemas or [root or database]]
        self.chosen: dict[str, str] = {}  # table -> the schema it is read from
        self.run_id = new_run_id()
        self._folders = {root.rstrip("/")} if root else {s for s in self.schemas if _is_folder(s)}
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table, clinical or stored by the user, from the first schema that has it."""
        if name not in self._cache:
            schema = self._find(name)
            self.chosen[name] = schema
            log.info("table %s is read from %s", name, schema)
            path = f"{schema}/{name}"
            if schema not in self._folders:
                df = self.spark.table(f"{schema}.{name}")
            elif is_published(self.spark, path):
                df = read_published(self.spark, path)
            else:
                df = self.spark.read.parquet(path)
            self._cache[name] = df
        return self._cache[name]

    def _has(self, schema: str, name: str) -> bool:
        if schema in self._folders:
            return exists(self.spark, f"{schema}/{name}")
        return self.spark.catalog.tableExists(f"{schema}.{name}")

    def _find(self, name: str) -> str:
        for schema in self.schemas:
            if self._has(schema, name):
                return schema
        raise LookupError(f"no table {name} in {', '.join(self.schemas)}")

    def input_paths(self) -> list[str]:
        """Folders and files that the tables there are would be read from."""
        paths = []
        for name in CLINICAL_TABLES:
            schema = next((s for s in self.schemas if self._has(s, name)), None)
            if schema in self._folders:
                paths.append(f"{schema}/{name}")
            elif schema is not None:
                about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.{name}")
                paths += [r["data_type"] for r in about.where("col_name = 'Location'").collect()]
        return paths

    def __getattr__(self, name: str) -> DataFrame:
        if name in CLINICAL_TABLES:
            return self.table(name)
        raise AttributeError(name)


def _is_folder(schema: str) -> bool:
    return "/" in schema or ":" in schema
