"""Named queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spotlake.llm.attention_lm import lm_scores
from spotlake.llm.exact_dedup import exact_dedup
from spotlake.llm.jaccard_tree import jaccard_components
from spotlake.llm.line_spread import line_dedup
from spotlake.llm.quality_net import quality_scores
from spotlake.llm.secret_ledger import secret_scan
from spotlake.llm.sentence_spans import without_repeats
from spotlake.llm.source_mix import source_mix
from spotlake.llm.spelling_variants import spelling_variants
from spotlake.llm.suffix_spans import without_repeats as without_repeated_bytes
from spotlake.llm.template_leaks import leaked_items
from spotlake.llm.token_alignment import token_alignment
from spotlake.llm.toxicity_svm import toxicity_scores


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(table(spark, folder, "documents"))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents"))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeated_bytes(table(spark, folder, "documents")).drop("kept")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(table(spark, folder, "documents"))


def op9_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"))


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix(table(spark, folder, "documents"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_secret_scan": op4_secret_scan,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_quality": op6_quality,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_line_dedup": op8_line_dedup,
        "op9_sentence_spans": op9_sentence_spans,
        "op10_source_mix": op10_source_mix,
        "op11_toxicity": op11_toxicity,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_token_alignment": op13_token_alignment,
    }
