"""Results with cleaned names, times, places and ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import UNIDENTIFIED_ATHLETE, UNTOUCHED_NAME_SERIES
from ..functions.numbers import minutes_from_text, minutes_to_text
from ..functions.text import clean_name, short_hash, title_case
from ..operators.groups import is_hot, with_rank
from ..operators.joins import flag_members, replace_by_lookup

LEADING = [
    "result_id",
    "race_id",
    "athlete_id",
    "race_date",
    "race_season",
    "gender",
    "finish_place",
    "athlete_name",
    "time",
    "time_float",
]
DROPPED = ["time_raw", "name_raw", "series", "school_raw", "team_raw", "state_raw"]


def with_race(results: DataFrame, races: DataFrame) -> DataFrame:
    """Date, season and series of the race on each result."""
    return results.join(races.select("race_id", "race_date", "race_season", "series"), "race_id", "left")


def with_finish_place(results: DataFrame) -> DataFrame:
    """Minimum rank of the time within race and gender; no time, no place."""
    keys = ["race_id", "gender"]
    ranked = with_rank(results, keys, "time_float", "finish_place", spread=is_hot(results, keys))
    known = F.col("race_id").isNotNull() & F.col("gender").isNotNull()
    return ranked.withColumn("finish_place", F.when(known, F.col("finish_place")))


def dim_results(
    staged: DataFrame, races: DataFrame, names: DataFrame, schools: DataFrame, non_people: DataFrame
) -> DataFrame:
    """``names`` and ``schools`` are spelling lookups, ``non_people`` lists names in one column."""
    placed = with_finish_place(staged.withColumn("time_float", minutes_from_text(F.col("time_raw"))))
    rows = with_race(placed, races)

    cleaned = clean_name(F.col("name_raw"))
    keep_case = F.col("series").eqNullSafe(UNTOUCHED_NAME_SERIES)
    rows = rows.withColumn("athlete_name", F.when(keep_case, cleaned).otherwise(title_case(cleaned)))
    rows = replace_by_lookup(rows, "athlete_name", names)
    rows = flag_members(rows, "athlete_name", non_people, non_people.columns[0], "is_unidentified_athlete")
    unidentified = F.when(F.col("is_unidentified_athlete"), F.lit(UNIDENTIFIED_ATHLETE))
    rows = rows.withColumn("athlete_name", unidentified.otherwise(F.col("athlete_name")))

    rows = rows.withColumn("school", title_case(F.col("school_raw")))
    rows = replace_by_lookup(rows, "school", schools)
    rows = rows.withColumns(
        {
            "time": minutes_to_text(F.col("time_float")),
            "team": F.col("team_raw"),
            "state": F.col("state_raw"),
            "athlete_id": short_hash(F.col("gender"), F.col("athlete_name")),
        }
    )
    rows = rows.withColumn("result_id", short_hash(F.col("athlete_id"), F.col("race_id")))

    carried = [c for c in staged.columns if c not in LEADING + DROPPED]
    return rows.select(*LEADING, *carried, "is_unidentified_athlete", "school", "team", "state")
