"""Numeric helpers with the rounding of ``round(x::numeric, n)`` (M3).

A double is first settled to 9 decimals, then rounded HALF_UP as a decimal:
this is what rounding the decimal form of a double does, and it keeps both
Spark and DuckDB off the binary-expansion edge (51.645 -> 51.65, not 51.64).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric_round(x: Column, digits: int) -> Column:
    settled = F.round(x, 9).cast("decimal(38,9)")
    return F.round(settled, digits).cast("double")


def numeric_round_sql(x: str, digits: int) -> str:
    return f"CAST(round(CAST(round({x}, 9) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def power(base: Column, exp) -> Column:
    """``base ^ exp`` as power (N11: Spark's ``^`` is XOR)."""
    return F.pow(base, exp)
