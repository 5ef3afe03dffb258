"""The queries of this subpackage, as the driver registers them, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import decontaminate, exact_dedup, language_id, line_dedup, minmax_dedup, ngram_lm, sentencepiece_viterbi, substring_dedup, token_counts, url_filter
from sparkloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.op1(spark, table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op2(spark, table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op3(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.op4(spark, table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op5(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.op6(spark, table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.op7(spark, table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.op8(spark, table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op9(spark, table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.op10(spark, table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository; it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_minmax_near_dedup, op2_line_dedup, op3_token_counts, op4_substring_dedup, op5_benchmark_decontamination, op6_lm_scoring, op7_exact_dedup, op8_language_id, op9_url_filter, op10_sentencepiece, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_minmax_near_dedup": minmax_dedup.ORACLE, "op2_line_dedup": line_dedup.ORACLE, "op4_substring_dedup": substring_dedup.ORACLE, "op5_benchmark_decontamination": decontaminate.ORACLE, "op7_exact_dedup": exact_dedup.ORACLE, "op9_url_filter": url_filter.oracle()}
