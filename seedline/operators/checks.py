"""Data checks. Each returns the violations as a DataFrame; callers decide whether to fail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A check that must hold found violations."""


def not_one_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that do not have exactly one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows <> 1")


def several_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with more than one distinct ``value``."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values")).filter("n_values > 1")


def require_none(violations: DataFrame, message: str, sample: int = 20) -> None:
    """Raise when there are violations, naming some of them."""
    found = violations.limit(sample).collect()
    if found:
        raise CheckFailed(f"{message}: {[row.asDict() for row in found]}")


def series_without_window(races: DataFrame, windows: DataFrame) -> DataFrame:
    """Series of races that no contribution window covers; their races drop out."""
    series = races.filter("series IS NOT NULL").select("series").distinct()
    return series.join(windows.select("series"), "series", "left_anti")


def unreferenced_files(inventory: DataFrame, needed: DataFrame) -> DataFrame:
    """Files that no race asks for."""
    return inventory.join(needed.select("sheet_name"), "sheet_name", "left_anti")


def stale_races(races: DataFrame, publications: DataFrame, months: int) -> DataFrame:
    """Races later than ``months`` after the last publication date."""
    # one row by construction, so the cross join is a broadcast of a single value
    last = publications.agg(F.max("penalty_list_date").alias("max_penalty_list_date"))
    cutoff = F.add_months("max_penalty_list_date", months)
    return races.join(F.broadcast(last)).withColumn("stale_cutoff", cutoff).filter(
        F.col("race_date") > F.col("stale_cutoff")
    )


def staleness_report(races: DataFrame, publications: DataFrame, months: int) -> DataFrame:
    """One row: how many races are late, the latest of them, and their series."""
    late = stale_races(races, publications, months)
    return late.agg(
        F.count(F.lit(1)).alias("n_races"),
        F.max("race_date").alias("latest_race_date"),
        F.array_join(F.array_sort(F.collect_set("series")), ",").alias("affected_series"),
    )
