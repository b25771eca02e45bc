"""Stored results as queries (K1, K2, K4, K6), the shown order (O3), item labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayframe.plans import pipeline
from stayframe.plans.base import Concepts, SCHEMAS, concept
from stayframe.sources.clinical import ClinicalTables
from stayframe.sources.snapshot import SnapshotStore
from stayframe.sources.staging import exists, run_folder, write_table


def _folder(c: Concepts) -> str:
    return f"{run_folder(c.t.spark, c.t.run_id)}/sinks"


@concept("saved_overwrite", SCHEMAS["cohort"])
def saved_overwrite(c: Concepts):
    """K1, K2: the second save replaces the first; what is read back is the cohort."""
    folder = _folder(c)
    pipeline.replace({"stays": c.get("cohort_select")}, path=folder)
    pipeline.replace({"stays": c.get("cohort")}, path=folder)
    return pipeline.saved(c.t.spark, folder, "stays")


@concept("saved_after_failure", SCHEMAS["cohort"])
def saved_after_failure(c: Concepts):
    """K1: a second save that fails in one of its rows leaves the first to be read."""
    folder = f"{_folder(c)}/failure"
    pipeline.replace({"stays": c.get("cohort")}, path=folder)
    later = c.get("cohort_select")
    last = later.agg(F.max("icustay_id").alias("m")).first()["m"]
    failing = later.withColumn("hadm_id", F.when(F.col("icustay_id") < last, F.col("hadm_id"))
                               .otherwise(F.raise_error(F.lit("planned failure")).cast("bigint")))
    try:
        pipeline.replace({"stays": failing}, path=folder)
    except Exception as e:  # the task's error reaches the driver under several types
        if "planned failure" not in str(e):
            raise
    return pipeline.saved(c.t.spark, folder, "stays")


@concept("search_path_read", "icustay_id bigint, hadm_id bigint, admission_type string, "
                             "stays_from string, admissions_from string")
def search_path_read(c: Concepts):
    """Stays stand in two schemas and are read from the first, admissions in the second only."""
    folder = f"{_folder(c)}/path"
    source, results = f"{folder}/source", f"{folder}/results"
    write_table(c.t.icustays, f"{source}/icustays")
    write_table(c.t.admissions, f"{source}/admissions")
    pipeline.replace({"icustays": c.t.icustays.join(c.get("cohort"), "icustay_id", "left_semi")}, path=results)
    t = ClinicalTables(c.t.spark, schemas=[results, source])
    out = t.icustays.select("icustay_id", "hadm_id").join(
        t.admissions.select("hadm_id", "admission_type"), "hadm_id")
    name = {n: s.rsplit("/", 1)[1] for n, s in t.chosen.items()}
    return out.withColumns({"stays_from": F.lit(name["icustays"]), "admissions_from": F.lit(name["admissions"])})


@concept("snapshot_refresh", SCHEMAS["comorbidity_flags"] + [("n_built", "bigint")])
def snapshot_refresh(c: Concepts):
    """K3: a stored concept is read while its input is unchanged and computed again when
    rows were appended; the rows are those of the whole input, built twice in three calls."""
    spark, folder = c.t.spark, f"{_folder(c)}/snapshot"
    codes = c.t.diagnoses_icd
    early = F.coalesce(F.col("icd9_code") < "4", F.lit(False))
    store = SnapshotStore(spark, f"{folder}/stored")

    def flags():  # a graph of its own each time, as a later application has
        return store.get(Concepts(ClinicalTables(spark, root=f"{folder}/input")), "comorbidity_flags")

    write_table(codes.where(early), f"{folder}/input/diagnoses_icd")
    flags()
    flags()
    write_table(codes.where(~early), f"{folder}/input/diagnoses_icd", mode="append")
    return flags().withColumn("n_built", F.lit(store.built).cast("bigint"))


@concept("saved_once", SCHEMAS["echo_data"])
def saved_once(c: Concepts):
    """K6: a create without a drop keeps the first result; a second one is refused."""
    path = f"{_folder(c)}/echo"
    first = pipeline.create(c.get("echo_data"), path)
    if pipeline.create(c.get("echo_data").limit(0), path) or not first:
        raise RuntimeError("a stored result was replaced")
    return c.t.spark.read.parquet(path)


@concept("bulk_drop", "concept string, n_rows bigint, left_over boolean")
def bulk_drop(c: Concepts):
    """K4: first-day concepts stored, counted, then dropped in one call."""
    folder, names = _folder(c), ("vitals_first_day", "labs_first_day", "gcs_min", "urine_first_day")
    pipeline.save({n: c.get(n) for n in names}, path=folder)
    counts = None
    for n in names:
        row = c.t.spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("concept"), F.count(F.lit(1)).alias("n_rows"))
        counts = row if counts is None else counts.unionByName(row)
    counts = c.intermediate(counts, "stored_counts")
    pipeline.drop(c.t.spark, list(names), path=folder)
    left = [n for n in names if exists(c.t.spark, f"{folder}/{n}")]
    return counts.withColumn("left_over", F.col("concept").isin(left) if left else F.lit(False))


@concept("severity_display", SCHEMAS["severity_attach"])
def severity_display(c: Concepts):
    return c.get("severity_attach")


@concept("labelled_items", "itemid bigint, label string, n_rows bigint")
def labelled_items(c: Concepts):
    """Chart rows per item with the dictionary's label (S4: left join, counted first)."""
    counts = c.t.chartevents.groupBy("itemid").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(c.t.d_items, "itemid", "left")
