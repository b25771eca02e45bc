"""Daily ventilator pressures and CVP (C10-C14): one scan, one shuffle.

PEEP, mean airway pressure, plateau pressure and CVP are the same computation
over different item ids, origins and day styles.  They run as one long-form
query keyed by ``concept``: a single filtered scan of chartevents, one hash
partitioning on (concept, icustay_id, hour bucket) shared by the origin and
previous-row lookups, then a map-side-combined daily aggregation.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayframe.functions.timeops import day_bucket, hour_field, micros_between
from stayframe.operators.sequence import scan
from stayframe.operators.twm import twm_value
from stayframe.plans.base import Concepts, concept

# Fixed values: (origin items, value items, day style) per concept.
TWM_CONCEPTS = {
    "peep": ((465, 505, 466, 506, 12750, 220339, 13253, 224700),
             (505, 506, 220339, 224700), "open"),
    "paw": ((224697,), (224697,), "open"),
    "pplat": ((224696,), (224696,), "half_mixed"),
    "cvp": ((220074,), (220074,), "half_mixed"),
}


def _concept_of(item_col, which: int):
    expr = None
    for name, spec in TWM_CONCEPTS.items():
        cond = item_col.isin(*spec[which])
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


LONG_SCHEMA = """
    concept string, icustay_id bigint, day bigint, avg_value double, max_value double,
    value_time double, twm double"""


@concept("twm_daily", LONG_SCHEMA)
def twm_daily(c: Concepts):
    all_items = sorted({i for s in TWM_CONCEPTS.values() for i in s[0]})
    stays = c.get("cohort").select("icustay_id")
    rows = (c.t.chartevents.where(F.col("itemid").isin(*all_items))
            .join(stays, "icustay_id", "left_semi")
            .select("icustay_id", "itemid", "charttime", "valuenum", "row_id",
                    _concept_of(F.col("itemid"), 0).alias("concept"),
                    _concept_of(F.col("itemid"), 1).alias("value_concept")))
    # Origin (first time of the stay among the origin items) and the previous
    # value row come from one scan over ranges of (concept, stay, time): a very
    # long stay spreads over many tasks.
    keys = ["concept", "icustay_id"]
    is_value = F.col("value_concept") == F.col("concept")
    looked = scan(rows, keys, ["charttime", "row_id"], carry={"prevval": is_value}, carry_cols=["charttime"],
                  start="origin", keep=c.keep("twm_rows"))
    vals = looked.where(is_value)
    prev = F.col("prevval_charttime")
    delta = micros_between(F.col("origin"), F.col("charttime"))
    day = None
    for name, (_, _, style) in TWM_CONCEPTS.items():
        b = day_bucket(delta, 24, 7, style)
        day = (F.when(F.col("concept") == name, b) if day is None
               else day.when(F.col("concept") == name, b))
    staged = vals.select("concept", "icustay_id", "itemid", "valuenum",
                         day.alias("day"), hour_field(prev, F.col("charttime")).alias("w"))
    v, w = F.col("valuenum"), F.col("w")
    g = staged.groupBy("concept", "icustay_id", "day", "itemid").agg(
        F.avg(v).alias("avg_value"), F.max(v).alias("max_value"),
        F.sum(v * w).alias("value_time"), F.sum(w).alias("_sw"))
    return g.select("concept", "icustay_id", "day", "avg_value", "max_value", "value_time",
                    twm_value(F.col("_sw"), F.col("value_time"), F.col("max_value"))
                    .alias("twm"))


def _one(c: Concepts, name: str):
    return (c.get("twm_daily").where(F.col("concept") == name)
            .select("icustay_id", "day",
                    F.col("avg_value").alias(f"avg_{name}"),
                    F.col("max_value").alias(f"max_{name}"),
                    F.col("value_time").alias(f"{name}_time"),
                    F.col("twm").alias(f"{name}_twm")))


def _schema(name: str) -> str:
    return (f"icustay_id bigint, day bigint, avg_{name} double, max_{name} double, "
            f"{name}_time double, {name}_twm double")


for _name in TWM_CONCEPTS:
    concept(f"table_{_name}", _schema(_name))(lambda c, _n=_name: _one(c, _n))


RESPI_SCHEMA = """
    icustay_id bigint, day bigint, avg_peep double, max_peep double, peep_time double,
    peep_twm double, avg_pplat double, max_pplat double, pplat_time double,
    pplat_twm double, avg_paw double, max_paw double, paw_time double, paw_twm double"""


@concept("respi_integration", RESPI_SCHEMA)
def respi_integration(c: Concepts):
    """PEEP ⟗ plateau ⟗ mean airway pressure by (stay, day); stays with >= 3 rows.

    Rows with a NULL day can never match and are dropped by the reference's
    "either day is not null" filter, so they are removed before joining.
    """
    keys = ["icustay_id", "day"]
    peep = c.get("table_peep").where(F.col("day").isNotNull())
    pplat = c.get("table_pplat").where(F.col("day").isNotNull())
    paw = c.get("table_paw").where(F.col("day").isNotNull())
    merged = peep.join(pplat, keys, "full_outer").join(paw, keys, "full_outer")
    per_stay = Window.partitionBy("icustay_id")
    return (merged.withColumn("_n", F.count(F.lit(1)).over(per_stay))
            .where(F.col("_n") >= 3).drop("_n"))
