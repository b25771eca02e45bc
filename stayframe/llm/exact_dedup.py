"""Exact duplicates: group by a 128-bit content hash, compare bytes inside, keep the smallest id.

Two texts are equal when they agree after every run of ASCII white space has
become one space (nothing is trimmed); a null text is an empty text.

Grouping key: the 128-bit MD5 of the normalised text, then the text itself, so
rows meet by hash and a collision of two different texts is told apart by their
bytes.  Spark combines equal texts inside each task before the shuffle, so a
text held by a third of all rows moves once per task.  Group facts go back to
the documents by a join on two digests; a hot digest is a skewed join key that
adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import ROW_KEY, SPACES, documents, only_rows, with_row_key


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def exact_groups(df: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Nulls: a null text is empty; rows with a null doc_id count in group_size but
    are kept only if no row of the group has an id (keep_id is then null).
    Repeated rows (one doc_id, one text) are each returned; all rows that carry
    the kept id are marked kept, and group_size counts rows.  An empty table
    gives an empty result.  Other input columns are ignored.
    """
    base = documents(df).select("doc_id", normalised(F.col("text")).alias("norm"))
    return _marked(base, content_hash).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _marked(base: DataFrame, content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """(doc_id, norm, others) -> h128, text_sha256, doc_id, others, keep_id, group_size, kept."""
    keyed = base.withColumns({"h128": content_hash(F.col("norm")), "text_sha256": F.sha2("norm", 256)})
    groups = (keyed.groupBy("h128", "text_sha256", "norm")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("h128", "text_sha256", "keep_id", "group_size"))
    return (keyed.drop("norm").join(groups, ["h128", "text_sha256"])
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: of each group of equal texts one, of the smallest id.

    A group without any id keeps one row too; an id with several texts is judged
    text by text.  Several rows of the smallest id differ in white space or other
    columns at most; the least ROW_KEY stays.  Texts move once more: the join's
    partitioning by ROW_KEY serves the last step too.
    """
    doc_id, text = F.expr("IF(_no_id, NULL, _id)"), F.col(f"c{df.columns.index('text')}").cast("string")
    base = with_row_key(df).select(doc_id.alias("doc_id"), normalised(F.coalesce(text, F.lit(""))).alias("norm"), *ROW_KEY)
    kept = (_marked(base).where("kept").groupBy("h128", "text_sha256")
            .agg(F.min(F.struct(*ROW_KEY)).alias("row")).select("row.*"))
    return only_rows(df, kept)


OP8_SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
