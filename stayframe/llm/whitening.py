"""Embedding whitening: leading principal components by block Jacobi-Davidson.

Vectors become integers x = floor(1024 c) + 100000 and are stored.  The
covariance V is never formed: a product V w is one Spark job in which tasks
centre their vectors exactly ((n x - S) in integers, then over n), multiply and
add, and the tasks' sums are added entry by entry.  The driver holds only
matrices of (dimension x some tens of columns).

Each round takes the Ritz pairs of a search space (Rayleigh-Ritz), locks the
leading ones whose residual |V u - e u| has reached double precision, and
extends the space by solutions of the projected correction equations
(I - ZZ')(V - e)(I - ZZ') t = -r, Z the locked and current vectors, from a few
MINRES steps.  All wanted pairs go through a round together, so a product of
the block costs one job, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import pick, record_batch, store

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
INNER_STEPS = 6  # MINRES steps of a correction, at most
INNER_TARGET = 1e-2  # its residual against the start, at which a correction is good enough
EPS = float(np.finfo(np.float64).eps)
TOLERANCE = 64 * EPS  # of a locked residual, against the largest eigenvalue
FLOOR = 1e-12  # where rounding of the products lets a residual shrink no more, it must be below this
_LARGEST = float(1 << 52)  # of |1024 c|: beyond, x is no exact integer in double precision
_CELLS = 1 << 20  # entries of vectors in work at once in a task

Product = Callable[[np.ndarray], np.ndarray]


def orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span ``new`` beside the orthonormal ``against``; directions that vanish go."""
    for _ in range(2):
        new = new - against @ (against.T @ new)
        size = np.linalg.norm(new, axis=0)
        new, spread, _ = np.linalg.svd(new[:, size > 0] / size[size > 0], full_matrices=False)
        new = new[:, spread > 1e-8 * spread.max(initial=0)]
    new = new - against @ (against.T @ new)
    return new / np.linalg.norm(new, axis=0)


def minres(operator: Product, rhs: np.ndarray, steps: int, target: float) -> np.ndarray:
    """Solutions of operator(x) = rhs, column by column with own step lengths; one call of the operator a step."""
    size = np.linalg.norm(rhs, axis=0)
    x, w, w_before, v_before = (np.zeros_like(rhs) for _ in range(4))
    v, left, off = rhs / np.where(size > 0, size, 1), size.copy(), np.zeros(len(size))
    cos, cos_before, sin, sin_before = np.ones(len(size)), np.ones(len(size)), np.zeros(len(size)), np.zeros(len(size))
    live = size > 0
    for _ in range(steps):
        if not live.any():
            break
        image = operator(v)
        diagonal = (v * image).sum(axis=0)
        nxt = image - diagonal * v - off * v_before  # Lanczos
        off_next = np.linalg.norm(nxt, axis=0)
        pivot = cos * diagonal - cos_before * sin * off  # Givens rotations of the tridiagonal matrix
        length = np.hypot(pivot, off_next)
        live &= length > 0
        safe = np.where(live, length, 1)
        w, w_before = (v - (sin_before * off) * w_before - (sin * diagonal + cos_before * cos * off) * w) / safe, w
        cos_before, sin_before = cos, sin
        cos, sin = np.where(live, pivot / safe, 1), np.where(live, off_next / safe, 0)
        x += np.where(live, cos * left, 0) * w
        left = -sin * left
        v, v_before, off = nxt / np.where(off_next > 0, off_next, 1), v, off_next
        live &= (np.abs(left) > target * size) & (off_next > 0)
    return x


def leading_eigenpairs(product: Product, dimension: int, k: int, seed: int = 0, steps: int = INNER_STEPS,
                       target: float = INNER_TARGET, tolerance: float = TOLERANCE, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the k largest eigenvalues of a symmetric operator, falling."""
    k, rng = min(k, dimension), np.random.default_rng(seed)
    locked, values = np.zeros((dimension, 0)), []
    space = orthonormal(rng.standard_normal((dimension, min(dimension, 2 * k))), locked)
    image = product(space)
    least, stuck = np.inf, 0
    for _ in range(rounds):
        h = space.T @ image
        ritz, turn = np.linalg.eigh((h + h.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        want = min(k - len(values), len(ritz))
        residual = image[:, :want] - space[:, :want] * ritz[:want]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        largest = max([*values[:1], ritz[0]])
        good = size <= tolerance * largest
        lock = want if good.all() else int(np.argmin(good))
        if not lock:
            stuck = stuck + 1 if size[0] > 0.5 * least else 0
            least = min(least, size[0])
            whole = space.shape[1] + len(values) == dimension
            lock = int((stuck > 2 or whole) and size[0] <= FLOOR * largest)
        if lock:
            locked, values = np.hstack([locked, space[:, :lock]]), [*values, *ritz[:lock]]
            space, image, ritz, residual = space[:, lock:], image[:, lock:], ritz[lock:], residual[:, lock:]
            least, stuck, want = np.inf, 0, want - lock
            if len(values) == k:
                falling = np.argsort(values)[::-1]
                return np.array(values)[falling], locked[:, falling]
        if space.shape[1] + want > 6 * k:  # thick restart
            space, image = space[:, :2 * k], image[:, :2 * k]
        aside = np.hstack([locked, space[:, :want]])

        def projected(t: np.ndarray) -> np.ndarray:
            return t - aside @ (aside.T @ t)

        def shifted(t: np.ndarray) -> np.ndarray:
            return projected(product(t) - t * ritz[:want])

        held = np.hstack([locked, space])
        new = orthonormal(minres(shifted, -projected(residual), steps, target), held)
        if not new.shape[1] and held.shape[1] < dimension:
            new = orthonormal(rng.standard_normal((dimension, min(max(1, want), dimension - held.shape[1]))), held)
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise ArithmeticError(f"residuals {size} did not reach {FLOOR} of {largest}")


def shifted_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, x array<bigint>) of the rows that take part; shorter vectors are extended by zeros first."""
    sound = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) * SCALE < F.lit(_LARGEST)))
    kept = pick(df, vec_id="bigint", embedding="array<double>").where(F.col("embedding").isNotNull() & sound)
    dimension = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    full = F.concat("embedding", F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(dimension) - F.size("embedding"))))
    return kept.select("vec_id", F.transform(full, lambda e: F.floor(F.lit(float(SCALE)) * e) + F.lit(SHIFT)).alias("x"))


def _parts(batch: pa.RecordBatch, dimension: int):
    """(rows, x) of a batch, some rows at a time."""
    step = max(1, _CELLS // dimension)
    for at in range(0, len(batch), step):
        part = batch.slice(at, step)
        yield part, part.column(1).flatten().to_numpy().reshape(-1, dimension)


_SUMS = pa.schema([("sums", pa.list_(pa.float64()))])


class Centred:
    """The vectors' distributed products; n rows, S their sums by dimension."""

    def __init__(self, rows: DataFrame):
        self.rows, self.spark = rows, rows.sparkSession
        sums = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s")).collect()
        self.n = rows.count()
        self.sums = np.zeros(len(sums), np.int64)
        for r in sums:
            self.sums[r["i"]] = r["s"]

    def total(self, of: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
        """Sum over all rows of what ``of`` gives for some centred rows: added in the task, then entry by entry."""
        n, sums = self.n, self.sums

        def run(batches):
            total = np.zeros(length)
            for batch in batches:
                for _, x in _parts(batch, len(sums)):
                    total += of((n * x - sums) / n).ravel()
            yield record_batch(_SUMS, [total])

        parts = self.rows.mapInArrow(run, "sums array<double>")
        added = parts.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(length)
        for r in added:
            out[r["i"]] = r["v"]
        return out

    def covariance_times(self, w: np.ndarray) -> np.ndarray:
        sent = self.spark.sparkContext.broadcast(w)
        out = self.total(lambda y: y.T @ (y @ sent.value), w.size).reshape(w.shape) / self.n
        sent.destroy()
        return out

    def trace(self) -> float:
        return float(self.total(lambda y: np.array([np.einsum("ij,ij->", y, y)]), 1)[0]) / self.n

    def identity_error(self, project: np.ndarray) -> float:
        """Largest entry of the covariance of the projected rows minus the identity."""
        k = project.shape[1]
        mean = self.total(lambda y: (y @ project).sum(axis=0), k) / self.n

        def products(y: np.ndarray) -> np.ndarray:
            w = y @ project - mean
            return w.T @ w

        return float(np.abs(self.total(products, k * k).reshape(k, k) / self.n - np.eye(k)).max(initial=0))


def squared_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums over dimensions of (n x - S)^2; None beyond 64 bits."""
    off = n * x - sums
    if off.size == 0 or float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0 ** 62:
        return (off * off).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in off.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


_OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                  ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def whiten(df: DataFrame, components: int = COMPONENTS, steps: int = INNER_STEPS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Components are numbered from 1 by falling eigenvalue; the largest entry of an
    eigenvector is positive.  Only components with some variance are given, so
    there are none for a single vector, for equal ones, or for an empty table.

    Nulls: vectors that are null or hold null or non-finite entries take no part
    (nor such whose 1024 c has no exact integer, from 2^52 on); a null id is kept.
    Vectors of unequal length are extended by zeros.  Repeated rows count and are
    returned as often as they come.  Ties: vectors of equal eigenvalues are any
    orthonormal basis of their space.  ``deviation`` is null beyond 64 bits.  Other
    columns, whatever their names, are ignored.
    """
    spark = df.sparkSession
    rows = store(shifted_vectors(df), "vectors")
    centred = Centred(rows)
    n, sums = centred.n, centred.sums
    trace = centred.trace() if n and len(sums) else 0.0
    if not trace:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double")
    values, vectors = leading_eigenpairs(centred.covariance_times, len(sums), components, steps=steps)
    some = values > 1e-13 * values[0]
    values, vectors = values[some], vectors[:, some]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    project = vectors / np.sqrt(values)
    error, k, explained = centred.identity_error(project), len(values), values / trace

    def run(batches):
        for batch in batches:
            for part, x in _parts(batch, len(sums)):
                white = ((n * x - sums) / n) @ project
                each = np.repeat(np.arange(len(x)), k)
                deviation = pa.array(squared_deviations(x, n, sums), pa.int64()).take(pa.array(each))
                yield record_batch(_OUT, part.column(0).take(pa.array(each)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                                   np.full(len(each), n), deviation, white.ravel(), np.tile(explained, len(x)), np.full(len(each), error))

    return rows.mapInArrow(run, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                "explained double, identity_error double")
