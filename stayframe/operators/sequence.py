"""Ordered look-ups within a key as a prefix scan over balanced ranges.

A plain ``Window.partitionBy(stay)`` puts every row of a stay into one task.
Here the rows are range-partitioned by (keys, time) and stored with the number
of their range (``ranged``): ranges hold about equal numbers of rows, so a stay
with a third of all rows is spread over a third of the ranges, and short stays
share one.  A scan then has two steps:

* one carry record per range, from aggregates over the range: its first and
  last rows, the last row for which a condition holds, the sum and the start of
  its last key.  Records are combined over the ranges in order (a running max of
  (keys, order, values), a running sum per last key: associative steps over as
  many records as there are ranges);
* windows over (range, keys), where what lies outside the range comes from the
  record of the range, if that is of the same key.

The records are few whatever the number of rows or stays, and rows are never
joined back to themselves.  Rows with equal (keys, time) are in one range.
``order`` is the time column first, then tie-breakers that make the order total
within ``keys``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.functions.timeops import micros_between
from stayframe.sources.staging import new_run_id, stage

RANGE = "_range"
Keep = Callable[[DataFrame], DataFrame]


def _keep(df: DataFrame) -> DataFrame:
    return stage(df.sparkSession, df, "ranged", new_run_id())


def ranged(df: DataFrame, keys: list[str], order: list[str], keep: Keep | None = None) -> DataFrame:
    """The rows in stored ranges of (keys, time), with the range's number; rows that have one stay as they are.

    ``keep`` must store the rows it is given (borders are sampled, so a plan that ran twice could have others).
    """
    if RANGE in df.columns:
        return df
    spread = df.repartitionByRange(*keys, order[0]).sortWithinPartitions(*keys, *order)
    return (keep or _keep)(spread.withColumn(RANGE, F.spark_partition_id()))


def _micros(time: Column) -> Column:
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time)


def _over_ranges() -> Window:
    """All ranges in order: as many rows as there are ranges."""
    return Window.orderBy(RANGE)


def _edge_rows(rows: DataFrame, order_by: list[Column], row: Column, depth: int, name: str) -> DataFrame:
    """Per range the first ``depth`` rows in the given order, as an array."""
    rank = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order_by))
    few = rows.select(RANGE, rank.alias("_rank"), row.alias("_row")).where(F.col("_rank") <= depth)
    return few.groupBy(RANGE).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_row"))), lambda x: x["_row"]).alias(name))


def _carried(records: DataFrame, value: str, step: Callable[[Column], Column]) -> Column:
    """The combined record of the ranges before: ``step`` over those whose last key is the same."""
    run = F.struct(F.col(f"{value}.key").alias("key"), step(F.col(f"{value}.value")).over(
        Window.partitionBy(f"{value}.key").orderBy(RANGE)).alias("value"))
    return run


def scan(df: DataFrame, keys: list[str], order: list[str], cols=(), prev: int = 0, nxt: int = 0,
         carry: dict | None = None, carry_cols=(), start: str | None = None, total: tuple[str, str] | None = None,
         keep: Keep | None = None) -> DataFrame:
    """One scan within ``keys``; the result keeps the range column, so that a later scan can go on from it.

    * ``prev``/``nxt`` (<= 2): add ``prev{k}_<col>`` / ``next{k}_<col>`` for ``cols``: lag / lead over ``order``.
    * ``carry`` ``{name: condition}``: add ``<name>_<col>`` for ``carry_cols``: the latest strictly earlier
      row for which the condition holds.
    * ``start``: add this column, the earliest time of the group.
    * ``total`` ``(name, column)``: add the running sum of the column over time, rows of equal time included
      (the default RANGE frame).
    """
    if prev > 2 or nxt > 2:
        raise ValueError("two rows back or ahead at most")
    carry, cols, carry_cols = carry or {}, list(cols), list(carry_cols)
    rows = ranged(df, keys, order, keep)
    own = list(rows.columns)
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    place = [key.alias("key"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]]
    row = F.struct(*place, *[F.col(c).alias(c) for c in cols])
    crow = F.struct(*place, *[F.col(c).alias(c) for c in carry_cols])
    time = F.col(order[0])

    # -- one record per range, then combined in the order of the ranges -------
    aggs = [F.max(F.when(cond, crow)).alias(f"_c{i}") for i, cond in enumerate(carry.values())]
    if start:
        aggs.append(F.max(F.struct(key.alias("key"), (-_micros(time)).alias("value"))).alias("_start"))
    both = [*keys, *order]
    deep = []
    for depth, edge, pick, towards in ((prev, "_tail", F.max, F.desc), (nxt, "_head", F.min, F.asc)):
        if depth == 1:  # the last (first) row of a range is its greatest (least)
            aggs.append(F.array(pick(row)).alias(edge))
        elif depth:
            deep.append(_edge_rows(rows, [towards(c) for c in both], row, depth, edge))
    records = rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    for edges in deep:
        records = records.join(edges, RANGE)
    if total:
        sums = rows.groupBy(RANGE, *keys).agg(F.sum(total[1]).alias("_s"))
        last = F.max(F.struct(key.alias("key"), F.col("_s").alias("value"))).alias("_total")
        records = records.join(sums.groupBy(RANGE).agg(last), RANGE)
    over = _over_ranges()
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    picked = [F.max(f"_c{i}").over(before).alias(f"_c{i}") for i in range(len(carry))]
    none = F.array().cast(f"array<{rows.select(row.alias('r')).schema['r'].dataType.simpleString()}>")
    for name, step in (("_tail", F.lag), ("_head", F.lead)):
        if name in records.columns:
            near = [F.coalesce(step(name, k).over(over), none) for k in (1, 2)]  # a range may hold one row only
            picked.append(F.concat(*near).alias(name))
    for name, step in (("_start", F.max), ("_total", F.sum)):
        if name in records.columns:
            records = records.withColumn(name, _carried(records, name, step))
            picked.append(F.lag(name).over(over).alias(name))
    if not picked:
        return rows
    records = records.select(RANGE, *picked)

    # -- the windows of a range; the record fills in what lies outside it -----
    # (by size estimates Spark may send the rows to the records, all of which are in one task)
    main = rows.join(F.broadcast(records), RANGE)
    inside = Window.partitionBy(RANGE, *keys)
    w = inside.orderBy(*order)

    def of_key(record: Column, value: Column) -> Column:
        return F.when(reduce(Column.__and__, [record["key"][f"k{i}"].eqNullSafe(F.col(k)) for i, k in enumerate(keys)]), value)

    out = []
    for depth, step, edge, name in ((prev, F.lag, "_tail", "prev"), (nxt, F.lead, "_head", "next")):
        if not depth:
            continue
        main = main.withColumn("_row", row)
        for k in range(1, depth + 1):
            main = main.withColumn(f"_{name}{k}", step("_row", k).over(w))
        for k in range(1, depth + 1):
            pick = F.col(f"_{name}{k}")  # never null inside, so null says that the range ends before
            for missing in range(k):  # rows of the key that this range has on that side
                at = F.get(F.col(edge), F.lit(k - 1 - missing))
                inner = F.col(f"_{name}{missing}").isNotNull() if missing else F.lit(True)
                outer = F.col(f"_{name}{missing + 1}").isNull()
                pick = F.coalesce(pick, F.when(inner & outer, of_key(at, at)))
            out += [pick[c].alias(f"{name}{k}_{c}") for c in cols]
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    for i, (name, cond) in enumerate(carry.items()):
        main = main.withColumn(f"_l{i}", F.max(F.when(cond, crow)).over(earlier))
        pick = F.coalesce(F.col(f"_l{i}"), of_key(F.col(f"_c{i}"), F.col(f"_c{i}")))
        out += [pick[c].alias(f"{name}_{c}") for c in carry_cols]
    if start:
        main = main.withColumn("_first", F.min(time).over(inside))
        began = F.timestamp_add("MICROSECOND", -F.col("_start.value"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
        out.append(F.coalesce(of_key(F.col("_start"), began), F.col("_first")).alias(start))
    if total:
        main = main.withColumn("_local", F.sum(total[1]).over(w))
        known = of_key(F.col("_total"), F.col("_total.value"))
        out.append((F.when(known.isNull(), F.col("_local")).otherwise(F.coalesce(F.col("_local"), F.lit(0)) + known)).alias(total[0]))
    return main.select(*own, *out)


def _plain(df: DataFrame, out: DataFrame) -> DataFrame:
    return out if RANGE in df.columns else out.drop(RANGE)


def neighbours(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
               prev: int = 1, nxt: int = 0, keep: Keep | None = None) -> DataFrame:
    """``prev{k}_<col>`` / ``next{k}_<col>``: lag/lead (k <= 2) within ``keys``."""
    return _plain(df, scan(df, keys, order, cols, prev=prev, nxt=nxt, keep=keep))


def last_before(df: DataFrame, keys: list[str], order: list[str], cond,
                cols: list[str], name: str | None = None, keep: Keep | None = None) -> DataFrame:
    """``<name>_<col>``: the latest strictly earlier row where ``cond`` holds
    (``cond`` may be a dict ``{name: condition}`` for several at once)."""
    conds = cond if isinstance(cond, dict) else {name: cond}
    return _plain(df, scan(df, keys, order, carry=conds, carry_cols=cols, keep=keep))


def group_start(df: DataFrame, keys: list[str], time_col: str, name: str, keep: Keep | None = None) -> DataFrame:
    """``min(time) over (partition by keys)``."""
    return _plain(df, scan(df, keys, [time_col], start=name, keep=keep))


def running_sum(df: DataFrame, keys: list[str], time_col: str, value: str, name: str,
                keep: Keep | None = None) -> DataFrame:
    """``sum(value) over (partition by keys order by time)`` with the default
    RANGE frame (rows at the same time are peers and all included)."""
    return _plain(df, scan(df, keys, [time_col], total=(name, value), keep=keep))
