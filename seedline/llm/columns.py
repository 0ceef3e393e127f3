"""Names for helper columns that no column of the caller has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_prefix(df: DataFrame) -> str:
    """A beginning that no column of ``df`` has, whatever the case of its letters."""
    taken = [c.lower() for c in df.columns]
    prefix = "own_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "x_"
    return prefix


def quoted(df: DataFrame) -> list[Column]:
    """All columns of ``df``, by name."""
    return [F.col(f"`{c}`") for c in df.columns]
