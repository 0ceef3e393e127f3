"""Registration of this subpackage's queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function of (spark, folder) under its own name; ``check`` is SQL over the tables."""

    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        LLM_QUERIES[build.__name__] = build
        if check:
            LLM_CHECKS[build.__name__] = check
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
