"""Documents to training data in five stages; each is written and read again before the next.

A stage's result may still read tables that the stage put into the shared folder. Since it is written before the
next stage begins, that one deletes them first, and run() deletes each stage's output once the next one's
is written. So the folder holds what two neighbouring stages need, and only the result in the end.

All stages: null texts count as empty, null ids, languages and sources are values of their own; texts of any length are taken
whole; repeated rows are copies; an empty table stays empty; other columns are carried along whatever
their names (the last stage returns its own columns only).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import bpe_tree, jaccard_join, mixing, quality_rules, suffix_dedup
from keepwell.llm.staging import drop, scope, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Folders that the latest stage's result still reads.
_left: list[str] = []


def _tidy(function: Stage) -> Stage:
    """The stage, after the tables that the stage before left behind are deleted."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop(spark, _left)
        with scope(_left):
            return function(spark, docs, sf_dir)

    return run_stage


@_tidy
def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules; of a null text nothing passes."""
    return quality_rules.keep_good(docs)


@_tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id. Documents without words all stay."""
    return jaccard_join.first_of_each(docs)


@_tidy
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in earlier ones; of which nothing is left go."""
    return suffix_dedup.without_repeats(docs)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's budget takes it; documents without words are not taken."""
    return mixing.mixed_documents(docs)


@_tidy
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number and the text they decode to, of every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_tree.round_trip(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", reject_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenise),
]

# Shingle joins and token ids have no SQL; tests/llm compares every stage with a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    earlier: list[str] = []
    for name, function in STAGES:
        output: list[str] = []
        result = function(spark, docs, sf_dir)
        with scope(output):
            docs = stage(result, name.replace(" ", "-"))
        drop(spark, earlier)
        earlier = output
    drop(spark, _left)
    return docs
