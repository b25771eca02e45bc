"""Score rules as data: ordered (condition, points) lists, first match wins.

A condition is SQL boolean text over named columns; points are an int, ``None``
(NULL) or a nested rule list (a CASE inside a CASE).  ``rule_column`` turns a
list into a ``when`` chain.  A condition that is NULL does not match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rule_column(rules, default=None) -> Column:
    expr = None
    for cond, points in rules:
        value = rule_column(points) if isinstance(points, list) else F.lit(points)
        c = F.expr(cond)
        expr = F.when(c, value) if expr is None else expr.when(c, value)
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr
