"""Physical-plan checks over every concept: no cartesian products or
nested-loop joins, item filters reach the parquet scan, columns are pruned."""

import re

import pytest

from stayframe.plans import registry
from stayframe.plans.base import Concepts
from stayframe.sources.fixture import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    log: dict[str, str] = {}
    c = Concepts(Tables(spark, SF), plan_log=log)
    for name in registry.QUERY_KEYS.values():
        c.get(name)
    return log


def test_every_concept_planned(plans):
    assert set(registry.QUERY_KEYS.values()) <= set(plans)


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = {k for k, p in plans.items()
           if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_dimensions_are_read_not_derived(plans):
    """Only the load step scans the raw events."""
    assert not [k for k, p in plans.items() if "/events.parquet" in p]


def test_lookups_read_their_input_once(plans):
    for name in ("twm_daily", "gcs_min", "mpp_nearest"):
        assert plans[name].count("chartevents") == 0, name  # the narrowed rows were stored


def test_item_filters_pushed_to_scan(plans):
    p = plans["twm_rows"]
    assert re.search(r"PushedFilters: \[[^\]]*In\(itemid", p)
    # the chart table is a partition of the stored event rows ...
    assert re.search(r"PartitionFilters: \[[^\]]*tbl[^\]]*= chartevents", p)
    # ... and only the needed columns are read
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    fields = [{f.split(":")[0] for f in s.split(",")} for s in schemas if "itemid" in s]
    assert fields and all(f <= {"row_id", "icustay_id", "itemid", "charttime", "valuenum"}
                          for f in fields)


def test_hot_stay_is_split(spark):
    """Half of all rows in one stay: the first-day join splits it although a grouping follows."""
    from pyspark.sql import functions as F

    from stayframe.operators.windows import first_window
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        events = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).alias("icustay_id"),
            F.col("id").cast("double").alias("valuenum"), t0.alias("charttime"),
            F.md5(F.col("id").cast("string")).alias("value"))
        stays = spark.range(500, numPartitions=2).select(F.col("id").alias("icustay_id"), t0.alias("intime"))
        got = (first_window(events, stays, 0, 24).groupBy("icustay_id")
               .agg(F.max("valuenum").alias("v"), F.max("value").alias("m")))
        assert got.count() == got.select("icustay_id").distinct().count() > 200
        got.write.format("noop").mode("overwrite").save()
        rows = got.collect()
        assert len(rows) > 200 and "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_score_joins_need_no_exchange(spark):
    """Stay-keyed tables are stored in equally many buckets of the stay; nothing is shuffled to join them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        log: dict[str, str] = {}
        c = Concepts(Tables(spark, SF), plan_log=log)
        c._buckets = 3  # neither 1 nor the session's number of shuffle partitions
        for name in ("sofa", "sapsii", "apsiii", "sirs", "global_merge"):
            c.get(name)
        for name in ("sofa", "sapsii", "apsiii", "sirs"):
            assert log[name].count("SortMergeJoin") >= 3 and "Exchange" not in log[name], log[name]
            assert "Bucketed: true" in c.get(name)._jdf.queryExecution().executedPlan().toString() \
                or "SelectedBucketsCount" in log[name]
        # the merge: the ventilated stays (a distinct over episodes, then aligned), the spine
        # once, and both sides of the day flags, which are rows of episodes and not bucketed
        assert log["global_merge"].count("SortMergeJoin") >= 11
        assert log["global_merge"].count("Exchange hashpartitioning") <= 5, log["global_merge"]
        c.release()
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("stayframe_" + c.t.run_id)]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_load_tasks_hold_a_bounded_number_of_events(spark, monkeypatch):
    """One file of events becomes rows in tasks of so many events, the same rows."""
    from pyspark.sql import functions as F

    from stayframe.sources import fixture
    monkeypatch.setattr(fixture, "LOAD_EVENTS", 50)
    t = Tables(spark, SF)
    events = t.raw("events").count()
    rows = t.event_rows.withColumn("_file", F.input_file_name())
    cols = ["tbl", "row_id", "subject_id", "hadm_id", "icustay_id", "itemid", "charttime", "value", "valuenum"]
    held = [r["n"] for r in rows.groupBy(F.regexp_extract("_file", r"part-(\d+)", 1))
            .agg(F.countDistinct("event_id").alias("n")).collect()]
    assert len(held) > events / 100 and max(held) < 150 and sum(held) == events
    plain = Tables(spark, SF, materialize=False).event_rows
    stored = t.event_rows.withColumn("tbl", F.col("tbl").cast("string"))
    assert stored.select(cols).exceptAll(plain.select(cols)).count() == 0 == plain.select(cols).exceptAll(stored.select(cols)).count()


def test_scores_send_no_table_through_the_driver(plans):
    """Stay-keyed tables join bucket by bucket; the interval index, larger than it is taken to be, is shuffled."""
    for name in ("sofa", "sapsii", "apsiii", "sirs"):
        assert "BroadcastExchange" not in plans[name] and "SortMergeJoin" in plans[name], name
    assert "BroadcastExchange" not in plans["gas_on_vent"] and "SortMergeJoin" in plans["gas_on_vent"]
