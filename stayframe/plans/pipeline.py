"""Run concepts in dependency order and store them (K1, K2, K4, K5).

``build`` evaluates a set of concepts on one shared ``Concepts`` instance, so
every node is computed once; ``replace`` publishes results in one step (the
``DROP TABLE IF EXISTS; CREATE TABLE AS`` of the scripts), ``save`` writes them
as catalog tables or plain files and ``drop`` removes a registry of stored
concepts in one call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayframe.plans.base import Concepts, SCHEMAS
from stayframe.sources.fixture import Tables
from stayframe.sources.published import collect_versions, publish, read_published
from stayframe.sources.staging import exists, remove, write_table


def build(spark: SparkSession, sf_dir: str, names: list[str] | None = None
          ) -> dict[str, DataFrame]:
    """Concept name -> shaped DataFrame; all names share one set of stored nodes."""
    from stayframe.plans import registry  # noqa: F401  (registers every concept)
    c = Concepts(Tables(spark, sf_dir))
    return {n: c.output(n) for n in (names or list(SCHEMAS))}


def save(results: dict[str, DataFrame], database: str | None = None,
         path: str | None = None) -> None:
    """Store each result as a catalog table or as plain parquet under ``path`` (overwrite in
    place, for other readers of the files; ``replace`` is safe against failed jobs)."""
    for name, df in results.items():
        if path:
            write_table(df, f"{path.rstrip('/')}/{name}")
        else:
            table = f"{database}.{name}" if database else name
            df.write.mode("overwrite").saveAsTable(table)


def replace(results: dict[str, DataFrame], path: str, keep: int = 2) -> None:
    """Publish each result under ``path`` in one step (K1, K2): a job that fails leaves the
    result that was there.  The ``keep`` newest versions stay for readers that have them open."""
    for name, df in results.items():
        folder = f"{path.rstrip('/')}/{name}"
        publish(df, folder)
        collect_versions(df.sparkSession, folder, keep)


def saved(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The current version of a result that ``replace`` has stored."""
    return read_published(spark, f"{path.rstrip('/')}/{name}")


def create(df: DataFrame, path: str) -> bool:
    """Store a result only where there is none yet (K6); False when there was one."""
    if exists(df.sparkSession, path):
        return False
    write_table(df, path, mode="errorifexists")
    return True


def display(df: DataFrame, *by: str) -> DataFrame:
    """A result in the order it is shown in (O3)."""
    return df.orderBy(*by)


def drop(spark: SparkSession, names: list[str], database: str | None = None,
         path: str | None = None) -> None:
    """Bulk ``DROP TABLE IF EXISTS`` over stored concepts (K4), or of their folders under ``path``."""
    for name in names:
        if path:
            remove(spark, f"{path.rstrip('/')}/{name}")
            continue
        table = f"{database}.{name}" if database else name
        spark.sql(f"DROP TABLE IF EXISTS {table}")
