"""Spark results against the DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from stayframe.plans import registry
from stayframe.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
KEYS = list(registry.QUERY_KEYS)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    res = duck.execute(entry.oracle_sql()[key])
    assert df.columns == [d[0] for d in res.description]
    assert _rows(df.collect()) == _rows(res.fetchall())


def test_every_key_has_an_oracle():
    assert set(registry.query_fns()) == set(registry.oracle_sqls())
    assert set(registry.query_fns()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "icustay_id" in df.columns
