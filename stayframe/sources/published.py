"""Stored results that are replaced in one step (K1, K2) and old versions collected.

A result lives in a folder of versions.  ``publish`` writes a new version beside the
others and only then points the folder's ``CURRENT`` file at it, by a rename that
replaces the old pointer.  A writer that fails, or loses its driver, leaves the pointer
as it was: readers see the whole old result or the whole new one, never a mixture or
nothing.  A version that a reader has open stays until ``collect_versions``.

``CURRENT`` has one JSON line per published version, the newest first, with an optional
note.  Of two writers at the same time the last to point wins; the other's version is
then in no line and stays until the folder is dropped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from stayframe.sources.staging import exists, remove

POINTER = "CURRENT"


def publish(df: DataFrame, folder: str, note: dict | None = None) -> str:
    """Write ``df`` as the folder's new version and point to it; returns the version's path."""
    spark, folder = df.sparkSession, folder.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    path = f"{folder}/{version}"
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception:
        remove(spark, path)  # what its tasks had written
        raise
    _point(spark, folder, [{"version": version, "note": note or {}}, *versions(spark, folder)])
    return path


def versions(spark: SparkSession, folder: str) -> list[dict]:
    """Published versions, the current one first; empty when nothing was published."""
    pointer = f"{folder.rstrip('/')}/{POINTER}"
    if not exists(spark, pointer):
        return []
    # one small file: read whole, so that its lines keep their order
    (text,) = spark.read.text(pointer, wholetext=True).first()
    return [json.loads(line) for line in text.splitlines() if line]


def is_published(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder.rstrip('/')}/{POINTER}")


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    found = versions(spark, folder)
    if not found:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder.rstrip('/')}/{found[0]['version']}")


def collect_versions(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete all but the ``keep`` newest published versions; returns how many went.

    The pointer forgets them first, so a lost driver leaves files nobody reads, not
    lines without files.  A version that is still being written is in no line and stays.
    """
    if keep < 1:
        raise ValueError("the current version is always kept")
    found = versions(spark, folder)
    old = found[keep:]
    if old:
        _point(spark, folder.rstrip("/"), found[:keep])
    for v in old:
        remove(spark, f"{folder.rstrip('/')}/{v['version']}")
    return len(old)


def _point(spark: SparkSession, folder: str, lines: list[dict]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{POINTER}-{uuid.uuid4().hex}")
    out = fresh.getFileSystem(conf).create(fresh, False)
    try:
        out.write(bytearray("".join(json.dumps(d, sort_keys=True) + "\n" for d in lines).encode()))
    finally:
        out.close()
    option = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(option, 1)
    overwrite[0] = option.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.getFileSystem(conf).getUri(), conf)
    files.rename(fresh, target, overwrite)
