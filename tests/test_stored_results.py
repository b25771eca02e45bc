"""Results replaced in one step, snapshots that know their input, and the search path."""

import os

import pytest
from pyspark.sql import functions as F

from stayframe.plans import pipeline, registry
from stayframe.plans.base import Concepts
from stayframe.sources import snapshot
from stayframe.sources.clinical import ClinicalTables
from stayframe.sources.published import collect_versions, is_published, publish, read_published, versions
from stayframe.sources.snapshot import SnapshotStore, input_fingerprint

SF = "/root/testdata/sf0.001"


def _numbers(spark, n):
    return spark.range(n, numPartitions=4)


def test_failed_job_leaves_the_result(spark, tmp_path):
    folder = str(tmp_path / "t")
    publish(_numbers(spark, 10), folder)
    # the last of four tasks fails, the others have written their files
    failing = _numbers(spark, 100).select(
        F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("planned failure")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="planned failure"):
        publish(failing, folder)
    assert read_published(spark, folder).count() == 10
    assert len([d for d in os.listdir(folder) if d.startswith("v-")]) == 1


def test_reader_keeps_its_version(spark, tmp_path):
    folder = str(tmp_path / "t")
    publish(_numbers(spark, 3), folder)
    opened = read_published(spark, folder)
    pipeline.replace({"t": _numbers(spark, 5)}, str(tmp_path))  # keeps two versions
    assert opened.count() == 3 and pipeline.saved(spark, str(tmp_path), "t").count() == 5


def test_a_result_may_read_itself(spark, tmp_path):
    folder = str(tmp_path / "t")
    publish(_numbers(spark, 3), folder)
    publish(read_published(spark, folder).unionByName(_numbers(spark, 4)), folder)
    assert read_published(spark, folder).count() == 7


def test_versions_are_collected(spark, tmp_path):
    folder = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        publish(_numbers(spark, n), folder, note={"n": n})
    unfinished = tmp_path / "t" / "v-unfinished"
    unfinished.mkdir()
    assert collect_versions(spark, folder, keep=2) == 2
    assert [v["note"]["n"] for v in versions(spark, folder)] == [4, 3]
    assert unfinished.exists()  # of a writer that has not pointed to it yet
    assert collect_versions(spark, folder, keep=2) == 0
    assert read_published(spark, folder).count() == 4
    with pytest.raises(ValueError):
        collect_versions(spark, folder, keep=0)


def test_nothing_published(spark, tmp_path):
    assert not is_published(spark, str(tmp_path)) and versions(spark, str(tmp_path)) == []
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path))


def test_fingerprint_of_files(spark, tmp_path):
    root = str(tmp_path / "in")
    _numbers(spark, 5).write.parquet(f"{root}/a")
    one = input_fingerprint(spark, [root])
    assert one == input_fingerprint(spark, [root])
    _numbers(spark, 1).write.mode("append").parquet(f"{root}/a")
    two = input_fingerprint(spark, [root])
    _numbers(spark, 6).write.mode("overwrite").parquet(f"{root}/a")  # equal rows, other files
    assert len({one, two, input_fingerprint(spark, [root])}) == 3


def test_snapshot_is_reused_only_on_equality(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "in")
    codes = spark.createDataFrame([(1, 1, "042"), (2, 2, "1960")], "subject_id int, hadm_id int, icd9_code string")
    codes.write.parquet(f"{root}/diagnoses_icd")

    def get():
        store = SnapshotStore(spark, str(tmp_path / "stored"))
        df = store.get(Concepts(ClinicalTables(spark, root=root)), "comorbidity_flags")
        return store.built, df.count()

    assert get() == (1, 2)
    assert get() == (0, 2)  # another store, graph and reader: the files are read
    codes.selectExpr("subject_id", "hadm_id + 10 AS hadm_id", "icd9_code").write.mode("append").parquet(
        f"{root}/diagnoses_icd")
    assert get() == (1, 4)
    monkeypatch.setattr(snapshot, "code_fingerprint", lambda: "other code")
    assert get() == (1, 4) and get() == (0, 4)
    ansi = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert get() == (1, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", ansi)


def test_graph_follows_its_files(spark, tmp_path):
    """The stored concepts of a directory are not read once its files are others."""
    (tmp_path / "sf").mkdir()
    sf = str(tmp_path / "sf")
    for t in ("events", "documents"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    first = registry.concepts_for(spark, sf)
    n = first.get("comorbidity_flags").count()
    assert registry.concepts_for(spark, sf) is first and n > 0
    more = spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", F.col("user_id") + 1_000_000)
    more.write.mode("append").parquet(f"{sf}/events.parquet")
    second = registry.concepts_for(spark, sf)
    assert second is not first and second.get("comorbidity_flags").count() == 2 * n
    registry.forget(sf)
    assert registry.concepts_for(spark, sf) is not second
    registry.forget(sf)


def test_search_path_order(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    _numbers(spark, 1).write.parquet(f"{a}/services")
    _numbers(spark, 2).write.parquet(f"{b}/services")
    _numbers(spark, 3).write.parquet(f"{b}/patients")
    publish(_numbers(spark, 4), f"{a}/kdigo")  # a stored result, not a clinical table
    spark.sql("CREATE DATABASE IF NOT EXISTS path_test")
    try:
        _numbers(spark, 5).write.saveAsTable("path_test.admissions")
        _numbers(spark, 6).write.saveAsTable("path_test.patients")
        t = ClinicalTables(spark, schemas=[a, "path_test", b])
        assert [t.services.count(), t.patients.count(), t.admissions.count(), t.table("kdigo").count()] == [1, 6, 5, 4]
        assert t.chosen == {"services": a, "patients": "path_test", "admissions": "path_test", "kdigo": a}
        assert ClinicalTables(spark, schemas=[b, "path_test"]).patients.count() == 3
        paths = t.input_paths()
        assert f"{a}/services" in paths and len(paths) == 3 and input_fingerprint(spark, paths)
        with pytest.raises(LookupError, match="noteevents"):
            t.noteevents
        with pytest.raises(ValueError):
            ClinicalTables(spark, root=a, schemas=[b])
    finally:
        spark.sql("DROP DATABASE path_test CASCADE")
