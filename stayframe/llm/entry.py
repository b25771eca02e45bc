"""Queries opN_<name> and their DuckDB SQL, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.llm import (cost_packing, exact_dedup, fm_dedup, langid, lm_score, mixing, packing, simhash, spelling,
                           suffix_dedup, topk, toxicity, whitening)
from stayframe.llm.common import read_table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"),
                      F.pmod(F.col("vec_id"), F.lit(topk.EVERY)) == 0)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents"))


def op11_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_packing.pack_balanced(read_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


_QUERIES = (op1_simhash_near_dedup, op2_suffix_array_dedup, op3_toxicity, op4_substring_dedup, op5_best_two_fit_packing,
            op6_source_mixing, op7_language_id, op8_exact_dedup, op9_exact_top_k, op10_lm_score, op11_cost_balanced_packing,
            op12_embedding_whitening, op13_spelling_variants)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op6_source_mixing": mixing.OP6_SQL, "op8_exact_dedup": exact_dedup.OP8_SQL, "op9_exact_top_k": topk.OP9_SQL}
