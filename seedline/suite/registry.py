"""Where queries and their checks are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import Fixtures, check_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None, extra: str = ""):
    """Register a function of the fixtures under its own name; ``check`` is SQL over the views."""

    def register(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        QUERIES[build.__name__] = lambda spark, folder: build(Fixtures(spark, folder))
        if check:
            CHECKS[build.__name__] = check_sql(check, extra)
        return build

    return register


def rounded(name: str, digits: int = 6) -> Column:
    """A float for comparison: engines add in different orders, so the last bits differ."""
    scale = 10.0**digits
    return (F.round(F.col(name) * scale) / scale).alias(name)


def rounded_sql(expr: str, name: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"round(({expr}) * {scale}) / {scale} AS {name}"
