"""A training corpus from the documents table: the stages, in order, and what each does to the rows.

Every stage takes all rows that the stage before it kept and is written as Parquet before the next one starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seedline.llm import byte_bpe, mixing, probminhash, quality, secret_scan
from seedline.session import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant takes for good ones; it learns from the labelled ones among ``docs``."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document of the least id."""
    return probminhash.representatives(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them masked."""
    return secret_scan.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the schedule takes it: not at all, or up to three times."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, digests of ids and of the bytes decoded from them, ids."""
    return byte_bpe.fingerprints(docs, carried=("source",), ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("tokens", tokens),
]

# The discriminant and the forest are trained models: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
