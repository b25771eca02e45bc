"""Invariants of the concept results on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from stayframe.plans import registry  # noqa: F401  (registers concepts)
from stayframe.plans.base import Concepts
from stayframe.sources.fixture import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def c(spark):
    return Concepts(Tables(spark, SF))


def test_urine_bins_roll_up(c):
    """Σ of the 6-h sums of a day equals that day's 24-h value (A10)."""
    u = c.get("urine_binned").where(F.col("urine_24h_kgh").isNotNull())
    g = u.groupBy("icustay_id", "day_24h").agg(
        F.sum("urine_6h_kgh").alias("s6"), F.first("urine_24h_kgh").alias("d24"))
    bad = g.where(F.abs(F.col("s6") / 4 - F.col("d24")) > 1e-9).count()
    assert bad == 0


def test_scores_are_sums_of_components(c):
    s = c.get("sofa")
    parts = ["respiration", "coagulation", "liver", "cardiovascular", "cns", "renal"]
    total = sum(F.coalesce(F.col(p), F.lit(0)) for p in parts)
    assert s.where(F.col("sofa") != total).count() == 0
    assert s.count() == c.t.icustays.count()


def test_episodes_partition_on_rows(c):
    """Every 'on' row gets exactly one episode number >= 1; episodes never overlap."""
    rows = c.get("vent_newevent")
    assert rows.where((F.col("mechvent") == 1) & (F.col("ventnum").isNull()
                                                  | (F.col("ventnum") < 1))).count() == 0
    ep = c.get("vent_durations").alias("a").join(
        c.get("vent_durations").alias("b"),
        (F.col("a.icustay_id") == F.col("b.icustay_id"))
        & (F.col("a.ventnum") < F.col("b.ventnum")))
    assert ep.where(F.col("a.starttime") > F.col("b.starttime")).count() == 0


def test_one_pick_per_key(c):
    """First-row and lowest-row picks give exactly one row per key."""
    f = c.get("first_per_group")
    assert f.count() == f.select("icustay_id", "itemid").distinct().count()
    g = c.get("gcs_min")
    assert g.count() == g.select("icustay_id").distinct().count() == c.t.icustays.count()


def test_day_spine_is_complete(c):
    sp = c.get("day_spine")
    assert sp.count() == 7 * c.get("cohort").count()
