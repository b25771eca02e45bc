"""Score building blocks (X9-X12): step bands, worst-of, sums, logistic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bands(x: Column, edges, points) -> Column:
    """Monotone step function: NULL in -> NULL out; x < edges[i] -> points[i];
    x >= edges[-1] -> points[-1] (X9)."""
    assert len(points) == len(edges) + 1
    expr = F.when(x.isNull(), F.lit(None))
    for e, p in zip(edges, points):
        expr = expr.when(x < e, F.lit(p))
    return expr.when(x >= edges[-1], F.lit(points[-1]))


def worst_of(vmin: Column, vmax: Column, smin: Column, smax: Column, normal: float) -> Column:
    """Score of whichever extreme lies farther from ``normal``; ties -> larger."""
    dmax, dmin = F.abs(vmax - normal), F.abs(vmin - normal)
    return (F.when(vmax.isNull(), F.lit(None))
            .when(dmax > dmin, smax)
            .when(dmax < dmin, smin)
            .when((dmax == dmin) & (smax >= smin), smax)
            .when((dmax == dmin) & (smax < smin), smin))


def sum_scores(*components: Column) -> Column:
    """Σ coalesce(component, 0) (X11)."""
    total = None
    for c in components:
        term = F.coalesce(c, F.lit(0))
        total = term if total is None else total + term
    return total


def logistic(z: Column) -> Column:
    """1 / (1 + exp(-z))."""
    return 1 / (1 + F.exp(-z))
