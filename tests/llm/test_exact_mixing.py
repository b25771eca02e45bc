"""Exact dedup and source mixing against DuckDB and plain Python."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from messy import as_counter, empty, messy, rows
from pyspark.sql import functions as F

from stayframe.llm import exact_dedup, mixing
from stayframe.llm.common import pick

SF = "/root/testdata/sf0.001"


def _duck(sql, table):
    con = duckdb.connect()
    if table is None:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    else:
        con.register("documents", table)
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


def _same(df, sql, table=None):
    names, want = _duck(sql, table)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    def settle(records):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in records), key=repr)
    assert set(names) == set(df.columns) and settle(got) == settle(want)


@pytest.mark.parametrize("operator, sql", [(exact_dedup.exact_groups, exact_dedup.OP8_SQL), (mixing.mix_plan, mixing.OP6_SQL)])
def test_against_duckdb(spark, operator, sql):
    _same(operator(spark.read.parquet(f"{SF}/documents.parquet")), sql)
    df = messy(spark)
    _same(operator(df), sql, pick(df, doc_id="bigint", text="string", source="string").toArrow())
    assert operator(empty(spark)).count() == 0


def test_exact_groups_by_hand(spark):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in rows():
        groups[norm(r[1])].append(r[0])
    want = [(i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g]
    assert as_counter(exact_dedup.exact_groups(messy(spark)).collect()) == as_counter(want)


def test_colliding_hashes_are_told_apart(spark):
    got = exact_dedup.exact_groups(messy(spark), content_hash=lambda c: F.lit("same"))
    assert as_counter(got.collect()) == as_counter(exact_dedup.exact_groups(messy(spark)).collect())


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (4, "b"), (3, None)], "doc_id bigint, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(df).collect()}
    assert got == {(None, None, 1, True), (None, 4, 2, False), (4, 4, 2, True), (3, 3, 1, True)}


def test_drop_keeps_columns_and_one_row_each(spark):
    df = messy(spark)
    kept = exact_dedup.drop_exact_duplicates(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {40, -5, 50} <= set(ids) and not {41, 54, 55, 51} & set(ids)


def test_drop_keeps_rows_without_id_and_texts_that_share_an_id(spark):
    from stayframe.llm import simhash
    long = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    table = [(None, long[0], "p"), (None, long[1], "p"), (None, long[1], "q"), (None, long[2], "p"), (4, long[2], "p"),
             (5, long[3], "p"), (5, long[4], "p"), (3, long[4].replace(" ", "  "), "p"), (6, long[5], "p"), (6, long[5], "p")]
    df = spark.createDataFrame(table, "doc_id bigint, text string, source string")
    want = {(None, long[0]), (None, long[1]), (4, long[2]), (5, long[3]), (3, long[4]), (6, long[5])}
    for stage in (exact_dedup.drop_exact_duplicates, simhash.keep_one):
        got = [stage(df.repartition(n)).collect() for n in (1, 3)]
        assert {(r["doc_id"], r["text"].replace("  ", " ")) for r in got[0]} == want and len(got[0]) == len(want)
        assert as_counter(got[0]) == as_counter(got[1])


def _targets(sizes, cap=3, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if weight[n] * level > cap * sizes[n]}
        if not full:
            return target | {n: weight[n] * level for n in open_}
        for n in full:
            target[n] = cap * sizes[n]
            left -= target[n]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, None: 5}, {"x": 0, "y": 7}, {"only": 12},
    {f"s{i}": (i * 37) % 91 for i in range(23)}])
def test_targets_fill_like_water(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(_targets(sizes))


def test_mix_repeats_rows_as_planned(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = {r["doc_id"]: r for r in mixing.mix_plan(df).collect()}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    copies = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert copies == {i: r["copies"] for i, r in plan.items() if r["copies"]}
    assert all(r["taken"] <= 3 * r["size"] for r in plan.values())
    assert plan == {r["doc_id"]: r for r in mixing.mix_plan(df.repartition(5)).collect()}
