"""Which races count for which penalty list."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import STALENESS_MONTHS
from ..operators import checks
from ..operators.joins import interval_join


def penalty_windows(publications: DataFrame, contributions: DataFrame) -> DataFrame:
    """Every publication date with every series' contribution window."""
    both = publications.select("penalty_list_season", "penalty_list_date").crossJoin(
        contributions.select(
            "series",
            "contributing_window_weeks",
            F.coalesce("current_season_supplants_previous_season", F.lit(False)).alias(
                "recent_season_only"
            ),
        )
    )
    weeks = F.col("contributing_window_weeks").cast("int")
    return both.withColumn("window_start_date", F.date_sub("penalty_list_date", weeks * 7))


def races_in_windows(races: DataFrame, windows: DataFrame) -> DataFrame:
    """Races from the window start up to, but not on, the list date."""
    return interval_join(
        races,
        windows,
        keys=["series"],
        at="race_date",
        start="window_start_date",
        end="penalty_list_date",
    )


def with_newest_season(windows: DataFrame, races: DataFrame) -> DataFrame:
    """Newest race season inside each window.

    Races shrink to one row per series and date before they meet the windows.
    """
    days = races.groupBy("series", "race_date").agg(F.max("race_season").alias("_season"))
    keys = ["penalty_list_season", "penalty_list_date", "series", "window_start_date"]
    newest = (
        races_in_windows(days, windows)
        .groupBy(*keys)
        .agg(F.max("_season").alias("most_recent_race_season_in_window"))
    )
    return windows.join(newest, keys, "left")


def races_by_penalty_window(
    publications: DataFrame,
    contributions: DataFrame,
    races: DataFrame,
    *,
    staleness_months: int = STALENESS_MONTHS,
    warn: bool = True,
) -> DataFrame:
    """One row per penalty list and contributing race."""
    if warn:
        warn_about_inputs(publications, contributions, races, staleness_months)
    races = races.select("series", "race_id", "race_date", "race_season")
    windows = with_newest_season(penalty_windows(publications, contributions), races)
    newest = F.col("race_season") == F.col("most_recent_race_season_in_window")
    return (
        races_in_windows(races, windows)
        .filter(~F.col("recent_season_only") | newest)
        .select(
            "penalty_list_season",
            "penalty_list_date",
            "series",
            "race_id",
            "race_date",
            "race_season",
        )
    )


def warn_about_inputs(
    publications: DataFrame, contributions: DataFrame, races: DataFrame, staleness_months: int
) -> None:
    """Warn about series without a window and about publication dates that look stale."""
    uncovered = [r[0] for r in checks.series_without_window(races, contributions).orderBy("series").collect()]
    if uncovered:
        warnings.warn(f"series without a contribution window are left out: {uncovered}", stacklevel=3)
    if publications.filter("penalty_list_date IS NOT NULL").isEmpty():
        warnings.warn("there is no valid penalty list date, cannot judge staleness", stacklevel=3)
        return
    report = checks.staleness_report(races, publications, staleness_months).first()
    if report["n_races"]:
        warnings.warn(
            f"{report['n_races']} race(s) are more than {staleness_months} month(s) after the last "
            f"penalty list, latest {report['latest_race_date']}, series {report['affected_series']}",
            stacklevel=3,
        )
