"""The pipeline's stages on tables with clashing names, maps, odd bytes, null and repeated ids, and without rows."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from stayframe.llm import exact_dedup, langid, mixing, simhash

KINDS = ("doc_id bigint, Doc_ID string, text string, Text int, lang string, Lang int, source string, Source int, n_chars bigint, "
         "_mix_rate double, _mix_source string, c0 int, extra map<string, int>")


def _rows(n=60):
    return [(None if i % 7 == 0 else i // 2, "x", None if i == 3 else f"the text number {i} of some {'words ' * (i % 5)}", 1,
             "en" if i % 2 else "de", 2, ["a", "b", None][i % 3], 3, 10, 0.5, "s", 4, {"k": i}) for i in range(n)]


@pytest.mark.parametrize("n", [0, 60])
def test_stages_keep_any_columns(spark, n):
    rows = _rows(n)
    df = spark.createDataFrame(rows, KINDS)
    for stage in (langid.accepted, exact_dedup.drop_exact_duplicates, simhash.keep_one, mixing.mixed_documents):
        out = stage(df)
        assert out.columns == df.columns, stage
        got = out.collect()
        assert all(tuple(r) in rows for r in got), stage
        assert bool(got) == bool(n), stage
    assert len(langid.accepted(df).collect()) == sum(r[2] is not None for r in rows)


def test_bytes_that_are_no_utf8(spark):
    odd = spark.sql("SELECT 1L AS doc_id, cast(X'61FF6220C3' AS string) AS text, 'en' AS lang, 'a' AS source, 5L AS n_chars "
                    "UNION ALL SELECT 2L, 'some words', 'en', 'a', 10L UNION ALL SELECT 5L, cast(X'FFFE' AS string), 'en', 'b', 2L")
    assert {r["doc_id"] for r in langid.identify(odd).collect()} == {1, 2, 5}
    assert {r["doc_id"] for r in langid.accepted(odd).collect()} == {1, 2}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, "").count() >= 1


@pytest.mark.parametrize("ids", ["null", "one", "unique"])
def test_mix_meets_targets_without_good_ids(spark, ids):
    """4000 documents of 10 words: 4 standard deviations of the draws, whatever the ids are."""
    doc_id = {"null": F.lit(None).cast("bigint"), "one": F.lit(5).cast("bigint"), "unique": F.col("id")}[ids]
    df = spark.range(4000).select(doc_id.alias("doc_id"), F.concat(F.lit("a b c d e f g h i w"), F.col("id")).alias("text"),
                                  F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    got = mixing.mix_plan(df).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(got) == 2
    for r in got:
        assert abs(r["taken"] - r["target"]) < 4 * 10 * (2000 * 0.25) ** 0.5
    assert mixing.mixed_documents(df).count() == sum(r["taken"] for r in got) / 10
