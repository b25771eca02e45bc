"""Whitening against numpy's full eigendecomposition and exact integers."""

import math

import numpy as np
import pytest

from stayframe.llm import whitening as wh

KINDS = "vec_id bigint, embedding array<double>, n string, Vec_ID int, x int"


def _frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, "n", 1, 2) for i, v in vectors], KINDS).repartition(parts)


def _check(df, vectors, components=8):
    kept = [(i, v) for i, v in vectors if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    width = max(len(v) for _, v in kept)
    x = [[math.floor(1024 * e) + 100000 for e in [*v, *[0.0] * (width - len(v))]] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    cov = y.T @ y / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, width)
    got = wh.whiten(df, components).collect()
    assert len(got) == n * k
    by_id = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-10
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-10)
        by_id.setdefault(r["vec_id"], {}).setdefault(r["deviation"], []).append((r["component"], r["whitened"]))
    for (i, _), row in zip(kept, x):
        assert sum((n * a - s) ** 2 for a, s in zip(row, sums)) in by_id[i]
    ids = [i for i, _ in kept]
    assert len(set(ids)) == len(ids)
    white = np.array([[w for _, w in sorted(next(iter(by_id[i].values())))] for i in ids])
    # y projected on unit eigenvectors: white = y u / sqrt(e); recover u and hold it against V
    u, *_ = np.linalg.lstsq(y, white * np.sqrt(values[:k]), rcond=None)
    if n > width:
        assert np.abs(u.T @ u - np.eye(k)).max() < 1e-9
        assert np.linalg.norm(cov @ u - u * values[:k], axis=0).max() < 1e-11 * values[0] * max(1, width)
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9


def test_against_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(24) * np.linspace(1, 0.4, 24)).tolist()) for i in range(400)]
    rows += [(1000, None), (1001, [None] * 24), (1002, [float("nan")] * 24), (1003, [float("inf"), 0.0]), (1004, [0.5, 0.25])]
    _check(_frame(spark, rows), rows)


def test_driver_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    _check(df, [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_few_dimensions_and_one_direction(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(50)]
    _check(_frame(spark, rows), rows)
    line = [(i, [i * 0.5, 1.0, i * 1.0]) for i in range(20)]
    got = wh.whiten(_frame(spark, line)).collect()
    assert len(got) == 20 and {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


def test_no_variance_and_empty(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])], [(i, [1.0, 2.0]) for i in range(5)], [(1, []), (2, [])]):
        out = wh.whiten(_frame(spark, rows, 1))
        assert out.collect() == [] and out.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_null_and_repeated_ids(spark):
    rows = [(None, [0.1, 0.9]), (None, [0.1, 0.9]), (5, [0.4, -0.2]), (5, [0.3, 0.7]), (6, [0.4, -0.2])]
    got = wh.whiten(_frame(spark, rows)).collect()
    assert sorted(str(r["vec_id"]) for r in got) == sorted(str(i) for i, _ in rows for _ in range(2))
    assert all(r["n"] == 5 for r in got)


def test_deviations_beyond_floats():
    n, x = 10 ** 6, np.array([[10 ** 8 + 1, 5], [3, 7]])
    sums = np.array([12345, 678])
    want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert wh.squared_deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]
    assert wh.squared_deviations(x // 1000, 7, sums) == [sum((7 * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x // 1000]


@pytest.mark.parametrize("values", [np.linspace(2, 1, 300), np.r_[5.0, 5, 5, 3, np.zeros(60)], np.r_[1 + 1e-9, 1, np.geomspace(0.9, 1e-9, 90)],
                                    np.geomspace(1, 1e-6, 9), np.ones(40)])
def test_residuals_reach_double_precision(values):
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    a = (q * values) @ q.T
    calls = []

    def product(w):
        calls.append(w.shape[1])
        return a @ w

    got, u = wh.leading_eigenpairs(product, len(values), 8)
    assert np.abs(got - np.sort(values)[::-1][:8]).max() < 1e-12 * values[0]
    assert np.linalg.norm(a @ u - u * got, axis=0).max() < 1e-12 * values[0]
    assert np.abs(u.T @ u - np.eye(u.shape[1])).max() < 1e-12
    assert len(calls) < 400


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    a = (q * np.r_[np.linspace(-3, -1, 10), np.linspace(1, 4, 20)]) @ q.T
    rhs = np.c_[rng.standard_normal((30, 4)), np.zeros(30)]
    x = wh.minres(lambda t: a @ t, rhs, 60, 1e-13)
    assert np.abs(a @ x - rhs).max() < 1e-10
