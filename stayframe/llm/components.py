"""Connected components of a distributed edge list (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import store


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges, larger end first, without loops."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _ordered(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (a long, b long) -> (node, root): root is the least node of the component.

    Each round is two grouped minima (combined in the tasks before the shuffle)
    and joins that adaptive execution splits when a node has very many edges.
    Rounds are stored in the shared checkpoint folder; only two sums reach the
    driver.  The rounds grow with the logarithm of the components' sizes.
    """
    now, seen = store(_ordered(edges), "edges"), None
    for i in range(max_rounds):
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        now = store(_small_star(_large_star(now)), f"round{i}")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
