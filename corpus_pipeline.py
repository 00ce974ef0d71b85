"""A training corpus from documents: quality, exact and near copies, mixture, token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchtrail.llm import byte_bpe, exact_dedup, mixing, quality, simhash
from touchtrail.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality and toxic ones go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies one document stays."""
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.take_mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mixture, and digests of ids and decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", drop_bad),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", encode),
]

# Trained classifiers, SimHash and sampling have no SQL; tests compare the stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = stored(out) if name != STAGES[-1][0] else out
    return docs
