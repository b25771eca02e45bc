"""Ranks within a key that no single task has to sort.

``row_number`` and ``dense_rank`` over a plain window put all rows of a key into one
task.  Here the rows are sorted over balanced ranges of the whole order and stored with
their place; ranks are counted within each range, and a key that goes on in the next
range starts there from what the ranges before it have counted.  What passes between
ranges is one record each: its last row, and the counts of its last key.  A key with a
third of all rows, or a third of all rows with equal values, is spread over a third of
the ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.operators.sequence import RANGE, Keep, _keep

PLACE = "_place"


def ranks(df: DataFrame, order: list[str | Column], wanted: dict[str, tuple[list[str], list[str] | None]],
          keep: Keep | None = None) -> DataFrame:
    """Add ranks over the rows in ``order`` (column names, or sort expressions with their direction).

    ``wanted`` is ``{name: (keys, values)}``: the row number within ``keys`` where ``values``
    is None, else the dense rank of the values.  Rows of equal keys, and within them rows of
    equal values, must be neighbours in ``order``; NULLs equal each other.  Rows that are
    equal in all of ``order`` are numbered in any order, as a window does.
    """
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    spread = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # ids rise within a range and from range to range: the place in the whole order
    rows = (keep or _keep)(spread.select("*", F.spark_partition_id().alias(RANGE),
                                         F.monotonically_increasing_id().alias(PLACE)))
    seen = F.struct(*sorted({c for keys, values in wanted.values() for c in [*keys, *(values or [])]}))
    over_ranges, inside = Window.orderBy(RANGE), Window.partitionBy(RANGE).orderBy(PLACE)

    ends = rows.groupBy(RANGE).agg(F.max_by(seen, PLACE).alias("_end"))
    ends = ends.select(RANGE, F.lag("_end").over(over_ranges).alias("_before"))
    # one record a range: it goes to the rows, whatever the sizes of both are taken to be
    main = (rows.join(F.broadcast(ends), RANGE)
            .withColumn("_prev", F.coalesce(F.lag(seen).over(inside), F.col("_before"))))
    counted = {}
    for i, (keys, values) in enumerate(wanted.values()):
        new = F.lit(1) if values is None else F.when(_same("_prev", [*keys, *values]), 0).otherwise(1)
        run = Window.partitionBy(RANGE, *keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
        counted[f"_n{i}"] = F.sum(new).over(run)
    main = main.withColumns(counted)

    # per range the count of its last key, summed over the ranges that key has filled
    last = main.groupBy(RANGE).agg(F.max_by(F.struct(seen.alias("row"), *counted), PLACE).alias("_last"))
    for i, (keys, _) in enumerate(wanted.values()):
        chain = Window.partitionBy(*[F.col(f"_last.row.{k}") for k in keys]).orderBy(RANGE)
        last = last.withColumn(f"_sum{i}", F.sum(f"_last._n{i}").over(chain))
    # (a key's ranges are neighbours, and it is the last key of all of them but the one it ends in)
    sums = [F.lag(f"_sum{i}").over(over_ranges).alias(f"_sum{i}") for i in range(len(wanted))]
    last = last.select(RANGE, F.lag("_last.row").over(over_ranges).alias("_key"), *sums)
    main = main.join(F.broadcast(last), RANGE)
    out = [(F.col(f"_n{i}") + F.when(_same("_key", keys), F.col(f"_sum{i}")).otherwise(0)).cast("int").alias(name)
           for i, (name, (keys, _)) in enumerate(wanted.items())]
    return main.select(*df.columns, *out)


def _same(row: str, cols: list[str]) -> Column:
    """The columns are those of another row; False where there is none."""
    equal = [F.col(f"{row}.{c}").eqNullSafe(F.col(c)) for c in cols]
    return reduce(Column.__and__, equal, F.col(row).isNotNull())
