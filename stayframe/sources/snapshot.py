"""Stored concepts that know what they were made of (K3).

A materialized result is only good while its inputs and the way it is computed are the
same.  ``SnapshotStore`` publishes a concept with its identity -- a fingerprint of the
input files, of the library's code and of the settings that change results -- and reads
the stored rows only where the identity is equal, also in a later application.
"""

from __future__ import annotations

import hashlib
from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.sources.published import publish, read_published, versions

CODE = ("functions", "operators", "plans", "sources")
SETTINGS = ("spark.sql.ansi.enabled", "spark.sql.session.timeZone", "spark.sql.caseSensitive")


def input_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Of the files below ``paths``: path, length and time of change of each, in any order.

    The listing is a distributed scan without the contents, folded to one row.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(paths))
               .select(F.xxhash64("path", "length", "modificationTime").alias("h"),
                       F.xxhash64("modificationTime", "path", "length").alias("g")))
    row = listing.agg(F.count(F.lit(1)), F.bit_xor("h"), F.bit_xor("g"),
                      F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr(tuple(str(x) for x in row)).encode()).hexdigest()


def code_fingerprint() -> str:
    """Of the library's sources: any change of a concept, or of what it calls, is another plan."""
    digest = hashlib.sha256()
    for part in CODE:
        for f in sorted(files("stayframe").joinpath(part).iterdir(), key=lambda f: f.name):
            if f.name.endswith(".py"):
                digest.update(f"{part}/{f.name}\0".encode() + f.read_bytes() + b"\0")
    return digest.hexdigest()


class SnapshotStore:
    """Concepts published under ``folder``, each in a folder of its name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.built = 0  # how often ``get`` had to compute

    def identity(self, concepts, name: str) -> dict:
        return {"concept": name, "input": input_fingerprint(self.spark, concepts.t.input_paths()),
                "code": code_fingerprint(), "spark": self.spark.version,
                "settings": {k: self.spark.conf.get(k, None) for k in SETTINGS}}

    def get(self, concepts, name: str) -> DataFrame:
        """The stored rows where their identity is that of the inputs now, else computed anew.

        The identity is taken before the concept is computed: inputs that change
        meanwhile give another identity at the next call, which computes again.
        """
        folder = f"{self.folder}/{name}"
        now = self.identity(concepts, name)
        found = versions(self.spark, folder)
        if not found or found[0]["note"] != now:
            publish(concepts.get(name), folder, note=now)
            self.built += 1
        return read_published(self.spark, folder)
