"""Registered queries over the text tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import (
    bpe_tree, chat, decontamination, jaccard_join, mixing, periodic_runs, quality_rules, sharding, spelling, suffix_dedup,
    token_counts, topk, toxicity,
)
from keepwell.llm.statements import LLM_SQL

__all__ = ["LLM_QUERIES", "LLM_SQL"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_threshold_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search_report(_table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.formatting_report(_table(spark, folder, "conversations"))


def op4_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_tree.codec_report(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeat_report(_table(spark, folder, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_report(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture_report(_table(spark, folder, "documents"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_report(_table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_report(_table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_report(_table(spark, folder, "documents"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination_report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, folder, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_threshold_topk, op2_toxicity, op3_chat_formatting, op4_bpe_codec, op5_suffix_dedup, op6_ngram_jaccard_join,
        op7_token_counts, op8_mixing, op9_sharding, op10_quality_rules, op11_spelling_variants, op12_decontamination,
        op13_periodic_runs,
    )
}
