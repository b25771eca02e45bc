"""Label + clean + pivot in one pass.

Item ids map to labels with a generated CASE expression (the maps are fixed
and small, so they stay inside whole-stage codegen instead of becoming a
join), and the pivot is a list of conditional aggregates over fixed labels,
so no distinct pass over the data is needed to discover pivot values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_map(col: Column, mapping: dict, default=None) -> Column:
    """CASE col WHEN k THEN v ... (first key wins, keys are item ids)."""
    expr = None
    for k, v in mapping.items():
        cond = col.isin(*k) if isinstance(k, tuple) else (col == k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    if default is not None:
        expr = expr.otherwise(default)
    return expr


def pivot_aggs(label: Column, value: Column, labels, funcs=("min", "max"),
               names: dict | None = None) -> list[Column]:
    """``func(CASE WHEN label = L THEN value END)`` for every label and func."""
    fns = {"min": F.min, "max": F.max, "avg": F.avg, "mean": F.avg}
    out = []
    for lab in labels:
        base = (names or {}).get(lab, lab)
        for fn in funcs:
            out.append(fns[fn](F.when(label == lab, value)).alias(f"{base}_{fn}"))
    return out
