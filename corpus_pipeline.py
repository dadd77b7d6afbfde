"""A training corpus in five stages, each one operator of ``playlens.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playlens.llm import bpe, decontaminate, langid, lines, neardup
from playlens.llm.queries import TOKENIZER, read
from playlens.llm.stages import write_stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.recognised(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; those that consist of such runs go.

    Single long lines stay: without them near copies would be remnants that near-dedup cannot recognise.
    """
    return lines.without_runs(docs, long_words=None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no text of the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of what the ids decode to."""
    return bpe.encoded(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, columns=("doc_id", "n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None  # SQL cannot express the learned language model; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
