"""Registered queries of the operators, and the SQL each is checked against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    decontamination,
    jaccard,
    line_dedup,
    lm,
    mixing,
    pii,
    quality,
    resampling,
    substrings,
    urls,
    vector_codes,
    vectors,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf, "documents")))


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", "removed", "text")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return decontamination.digest(found)


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_lm(table(spark, sf, "documents"))


def op6_substrings(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(table(spark, sf, "documents")))


def op7_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf, "embeddings"))


def op8_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents"))


def op9_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "block_share")


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents"))


def op11_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.digest(resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


def op12_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    return winnowing.digest(winnowing.edit_marks(table(spark, sf, "documents")))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.digest(vector_codes.compress(table(spark, sf, "embeddings")))


def queries() -> dict[str, Query]:
    return {
        "op1_pii": op1_pii,
        "op2_line_dedup": op2_line_dedup,
        "op3_decontamination": op3_decontamination,
        "op4_quality": op4_quality,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_substrings": op6_substrings,
        "op7_vectors": op7_vectors,
        "op8_jaccard": op8_jaccard,
        "op9_url_filters": op9_url_filters,
        "op10_mixing": op10_mixing,
        "op11_resampling": op11_resampling,
        "op12_winnowing": op12_winnowing,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_pii": pii.oracle(),
        "op3_decontamination": decontamination.oracle(),
        "op6_substrings": substrings.oracle(),
        "op10_mixing": mixing.oracle(),
        "op11_resampling": resampling.oracle(),
        "op12_winnowing": winnowing.oracle(),
        "op13_vector_codes": vector_codes.oracle(),
    }
