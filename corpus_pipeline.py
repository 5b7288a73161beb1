"""Corpus pipeline: quality classifier, MinHash near-dedup, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and its predecessor's rows; ``run``
writes them as Parquet in the cluster's shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricenet.llm import bpe, minhash_forest, mixing, quality
from pricenet.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the compression classifier accepts (operator 1)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five words, similarity 0.8 (operator 3)."""
    return minhash_forest.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources come near their target weights (operator 4)."""
    return mixing.mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded-text digests of every row that is left (operator 10)."""
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("mixing", mix_stage),
    ("bpe_encoding", encode_stage),
]

# The classifier, the near-duplicate search and the byte pair merges are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *steps, (_, last) = STAGES
    for _, stage in steps:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
