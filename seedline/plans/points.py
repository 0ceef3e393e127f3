"""Race penalties and race points, both vintages side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import (
    FIRST_PUBLISHED_SEASON,
    GENDERS,
    MIN_PENALTIED_FINISHERS,
    NO_POINTS_REASONS,
    PODIUM_SIZE,
    VINTAGES,
)
from ..functions.numbers import mean_ln, race_points, round2
from ..operators.groups import dealt, group_sizes, is_hot, null_safe_join, with_group_stats, with_rank
from ..operators.joins import latest_on_or_before
from ..session import durable, rows_per_task

RACE = ["race_id", "gender"]
ATHLETE_SEASON = ["race_season", "athlete_id"]


def with_penalty_list_date(results: DataFrame, penalties: DataFrame) -> DataFrame:
    """Latest penalty list on or before the race, over all seasons."""
    dates = latest_on_or_before(results, "race_date", penalties, "penalty_list_date")
    # one row per calendar date of a race: bounded by the calendar
    return results.join(F.broadcast(dates), "race_date", "left")


def with_penalties(results: DataFrame, penalties: DataFrame) -> DataFrame:
    """The athlete's penalties on the applicable list."""
    wanted = penalties.select(
        "penalty_list_date",
        "athlete_id",
        *[F.col(f"standardized_athlete_penalty_{v}").alias(f"athlete_penalty_{v}") for v in VINTAGES],
    )
    return results.join(wanted, ["penalty_list_date", "athlete_id"], "left")


def with_registration(results: DataFrame, registrations: DataFrame) -> DataFrame:
    """The athlete's registration in the race's season (ghosts included)."""
    keys = registrations.select("athlete_id", "race_season", "registration_id", "is_ghost_registration")
    return results.join(keys, ["athlete_id", "race_season"], "left")


def with_finish_flags(results: DataFrame) -> DataFrame:
    finished = F.col("time_float").isNotNull()
    registered = finished & F.col("registration_id").isNotNull()
    ghost = F.coalesce("is_ghost_registration", F.lit(False))
    return results.withColumns(
        {
            "is_registered_or_ghost_finish": registered,
            "is_registered_finish": registered & ~ghost,
            **{
                f"is_penaltied_athlete_finish_{v}": finished & F.col(f"athlete_penalty_{v}").isNotNull()
                for v in VINTAGES
            },
        }
    )


def with_penaltied_counts(results: DataFrame, *, spread: bool) -> DataFrame:
    """Penaltied finishers per race and gender."""
    counts = {
        f"penaltied_athlete_count_{v}": F.count(F.when(F.col(f"is_penaltied_athlete_finish_{v}"), 1))
        for v in VINTAGES
    }
    return with_group_stats(results, RACE, counts, spread=spread)


def with_penaltied_places(results: DataFrame, *, spread: bool) -> DataFrame:
    """Rank of the time among the penaltied finishers of the race and gender."""
    for v in VINTAGES:
        flag, place = f"is_penaltied_athlete_finish_{v}", f"penaltied_athlete_place_{v}"
        results = with_rank(results, [*RACE, flag], "time_float", place, spread=spread)
        results = results.withColumn(place, F.when(F.col(flag), F.col(place)))
    return results


def on_podium(vintage: str) -> Column:
    """Top penaltied finishers of a race with enough of them; ties at the edge all count."""
    enough = F.col(f"penaltied_athlete_count_{vintage}") >= MIN_PENALTIED_FINISHERS
    return enough & F.col(f"penaltied_athlete_place_{vintage}").between(1, PODIUM_SIZE[vintage])


def podium_logs() -> dict[str, Column]:
    """Aggregates: mean logs of penalty and time over the podium of each vintage."""
    stats = {}
    for v in VINTAGES:
        stats[f"race_penalty_{v}"] = mean_ln(F.when(on_podium(v), F.col(f"athlete_penalty_{v}")))
        stats[f"race_penalty_time_{v}"] = mean_ln(F.when(on_podium(v), F.col("time_float")))
    return stats


def race_stats(results: DataFrame, *, spread: bool) -> DataFrame:
    """Per race and gender: penaltied finishers and mean logs over the podium of each vintage; one small row each.

    ``results`` is read three times: pass a table. Only the podium of a race meets in a task, as Spark drops all others before the shuffle.
    """
    flags = {v: F.col(f"is_penaltied_athlete_finish_{v}") for v in VINTAGES}
    rows = results.select(*RACE, "time_float", *[c for v in VINTAGES for c in (f"athlete_penalty_{v}", f"is_penaltied_athlete_finish_{v}")])
    rows = rows.filter(reduce(lambda a, b: a | b, flags.values()))
    counted = rows.groupBy(*RACE).agg(*[F.count(F.when(flags[v], 1)).alias(f"penaltied_athlete_count_{v}") for v in VINTAGES])
    podiums = []
    for v in VINTAGES:
        place = f"penaltied_athlete_place_{v}"
        placed = with_rank(rows.filter(flags[v]), RACE, "time_float", place, spread=spread)
        placed = placed.filter(F.col(place) <= PODIUM_SIZE[v])
        podiums.append(placed.select(*RACE, F.lit(v).alias("_vintage"), F.col(f"athlete_penalty_{v}").alias("_penalty"), "time_float"))
    logs = []
    for v in VINTAGES:
        own = F.col("_vintage") == v
        logs.append(mean_ln(F.when(own, F.col("_penalty"))).alias(f"race_penalty_{v}"))
        logs.append(mean_ln(F.when(own, F.col("time_float"))).alias(f"race_penalty_time_{v}"))
    podium = reduce(DataFrame.unionByName, podiums).groupBy(*RACE).agg(*logs)
    stats = null_safe_join(durable(counted, "race-counts"), podium, RACE)
    for v in VINTAGES:
        enough = F.col(f"penaltied_athlete_count_{v}") >= MIN_PENALTIED_FINISHERS
        stats = stats.withColumns({c: F.when(enough, F.col(c)) for c in (f"race_penalty_{v}", f"race_penalty_time_{v}")})
    return durable(stats, "race-stats")


def geometric_means(rows: DataFrame, known: Column | None = None) -> DataFrame:
    """Mean logs to race penalty (two decimals) and race penalty time, where ``known``."""
    columns = {}
    for v in VINTAGES:
        columns[f"race_penalty_{v}"] = round2(F.exp(f"race_penalty_{v}"))
        columns[f"race_penalty_time_{v}"] = F.exp(f"race_penalty_time_{v}")
    if known is not None:
        columns = {name: F.when(known, c) for name, c in columns.items()}
    return rows.withColumns(columns)


def race_penalties(results: DataFrame, races: DataFrame) -> DataFrame:
    """Every race with both genders and its penalties (NULL where the race is unscorable)."""
    grid = races.select("race_id", "race_season", "race_date").withColumn(
        "gender", F.explode(F.array(*[F.lit(g) for g in GENDERS]))
    )
    podium = results.filter(reduce(lambda a, b: a | b, [on_podium(v) for v in VINTAGES]))
    logs = podium.groupBy(*RACE).agg(*[c.alias(n) for n, c in podium_logs().items()])
    return geometric_means(grid.join(logs, RACE, "left"))


def series_config(contributions: DataFrame) -> DataFrame:
    return contributions.select(
        "series",
        F.col("is_point_generating").try_cast("boolean").alias("is_point_generating_race"),
        "compression_factor_di",
        "compression_factor_sp",
    )


def compression_factor_26() -> Column:
    one = F.lit(1.0)
    return (
        F.when(F.col("discipline") == "DI", F.coalesce("compression_factor_di", one))
        .when(F.col("discipline") == "SP", F.coalesce("compression_factor_sp", one))
        .otherwise(one)
    )


def with_points(results: DataFrame) -> DataFrame:
    """Time ratios and points of registered finishes in races that give points."""
    scored = F.col("is_registered_finish") & F.col("is_point_generating_race")
    results = results.withColumns(
        {
            "compression_factor_25": F.lit(1.0),
            "compression_factor_26": compression_factor_26(),
            **{
                f"ma_time_penalty_ratio_{v}": F.when(
                    scored, F.try_divide("time_float", f"race_penalty_time_{v}")
                )
                for v in VINTAGES
            },
        }
    )
    return results.withColumns(
        {
            f"race_points_{v}": race_points(
                F.col(f"race_penalty_{v}"),
                F.col(f"ma_time_penalty_ratio_{v}"),
                F.col(f"compression_factor_{v}"),
            )
            for v in VINTAGES
        }
    )


def with_season_ranks(results: DataFrame, *, spread: bool) -> DataFrame:
    """Rank of the points among the athlete's results of the season, and per technique."""
    for v in VINTAGES:
        for name, keys in (
            (f"race_rank_by_athlete_season_{v}", ATHLETE_SEASON),
            (f"race_rank_per_technique_by_athlete_season_{v}", [*ATHLETE_SEASON, "technique"]),
        ):
            results = with_points_rank(results, keys, f"race_points_{v}", name, spread=spread)
    return results


def with_points_rank(
    results: DataFrame, keys: list[str], points: str, out: str, *, spread: bool
) -> DataFrame:
    """Rank of the points; registered finishes without points share the place after all others."""
    place = F.col(out)
    if spread:
        results = with_rank(results, keys, points, out, spread=True)
        results = with_group_stats(results, keys, {"_scored": F.count(points)}, spread=True)
        place = F.coalesce(place, F.col("_scored") + 1)
    else:
        window = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(points))
        results = results.withColumn(out, F.rank().over(window).cast("bigint"))
    return results.withColumn(out, F.when(F.col("is_registered_finish"), place)).drop("_scored")


def points_text() -> Column:
    shown = (F.col("_list_season") >= FIRST_PUBLISHED_SEASON) & F.col("is_registered_finish")
    points = F.col("race_points_26")
    # a double of ten million and more would print with an exponent
    plain = F.regexp_replace(points.cast("decimal(38,2)").cast("string"), "0$", "")
    return F.when(shown, F.when(points >= 1e7, plain).otherwise(points.cast("string"))).otherwise(F.lit(""))


def reason_for_no_points() -> Column:
    """First reason that applies; a condition that is unknown does not apply."""
    not_eligible = F.col("registration_id").isNull() | ~F.col("is_registered_finish")
    few = F.col("penaltied_athlete_count_26") < MIN_PENALTIED_FINISHERS
    return (
        F.when(F.col("_list_season") < FIRST_PUBLISHED_SEASON, F.lit(""))
        .when(~F.col("is_point_generating_race"), F.lit(NO_POINTS_REASONS["not_scored"]))
        .when(F.col("time_float").isNull(), F.lit(NO_POINTS_REASONS["no_time"]))
        .when(not_eligible, F.lit(NO_POINTS_REASONS["not_eligible"]))
        .when(few, F.lit(NO_POINTS_REASONS["unscorable"]))
        .when(F.col("race_points_26").isNull(), F.lit(NO_POINTS_REASONS["other"]))
        .otherwise(F.lit(""))
    )


RESULT_COLUMNS = [
    "result_id",
    "race_id",
    "athlete_id",
    "race_season",
    "registration_id",
    "athlete_name",
    "time",
    "time_float",
    "finish_place",
    "race_date",
    "gender",
    "penalty_list_date",
    "athlete_penalty_25",
    "athlete_penalty_26",
    "is_registered_or_ghost_finish",
    "is_registered_finish",
    "is_penaltied_athlete_finish_25",
    "is_penaltied_athlete_finish_26",
    "penaltied_athlete_place_25",
    "penaltied_athlete_place_26",
    "penaltied_athlete_count_25",
    "penaltied_athlete_count_26",
]
RACE_COLUMNS = ["race_name", "discipline", "technique", "series", "division", "race_format", "venue"]
POINT_COLUMNS = [
    "is_point_generating_race",
    "race_penalty_25",
    "race_penalty_time_25",
    "race_penalty_26",
    "race_penalty_time_26",
    "compression_factor_25",
    "compression_factor_26",
    "ma_time_penalty_ratio_25",
    "ma_time_penalty_ratio_26",
    "race_points_25",
    "race_points_26",
    "race_rank_by_athlete_season_25",
    "race_rank_per_technique_by_athlete_season_25",
    "race_rank_by_athlete_season_26",
    "race_rank_per_technique_by_athlete_season_26",
]


def results_with_penalties(
    results: DataFrame, penalties: DataFrame, registrations: DataFrame
) -> DataFrame:
    """Results with list date, penalties, registration and finish flags."""
    rows = with_penalty_list_date(results, penalties)
    rows = with_penalties(rows, penalties)
    rows = with_registration(rows, registrations)
    return with_finish_flags(rows)


def ext_results(
    contributions: DataFrame,
    penalties: DataFrame,
    results: DataFrame,
    races: DataFrame,
    registrations: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per result with points, ranks and the reason for missing points. ``columns``: those that are read, all by default; rows
    are dealt anew only for places and ranks that are."""
    read = set(columns or [*RESULT_COLUMNS, *POINT_COLUMNS])
    places_read, ranks_read = (any(c.startswith(start) for c in read) for start in ("penaltied_athlete_place_", "race_rank_"))
    wanted = ["result_id", *RACE, "athlete_id", "race_season", "athlete_name", "time", "time_float"]
    results = results.select(*wanted, "finish_place", "race_date")
    largest_race, total = group_sizes(results, RACE)
    hot_race, hot_athlete = largest_race > rows_per_task(results.sparkSession), is_hot(results, ATHLETE_SEASON)

    rows = results_with_penalties(results, penalties, registrations)
    rows = durable(rows, "results-with-penalties")  # read for the statistics of the races and again for the rows
    rows = null_safe_join(rows, race_stats(rows, spread=hot_race), RACE)
    counts = [f"penaltied_athlete_count_{v}" for v in VINTAGES]
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    if places_read and not hot_race:
        rows = dealt(rows, RACE, total)
    rows = with_penaltied_places(rows, spread=hot_race)

    meta = races.select(
        "race_id", F.col("race_season").alias("_list_season"), *RACE_COLUMNS, F.lit(True).alias("_listed")
    )
    config = series_config(contributions)
    rows = rows.join(meta.join(config, "series", "left"), "race_id", "left")
    # penalties belong to races that are on the race table, for the two known genders
    listed = F.col("gender").isin(GENDERS) & F.col("_listed")
    rows = rows.withColumn("_list_season", F.when(listed, F.col("_list_season")))
    rows = with_points(geometric_means(rows, listed))
    if ranks_read:
        rows = durable(rows, "results-with-points") if hot_athlete else dealt(rows, ATHLETE_SEASON, total)
    rows = with_season_ranks(rows, spread=hot_athlete)
    rows = rows.select(
        *RESULT_COLUMNS,
        *RACE_COLUMNS,
        *POINT_COLUMNS,
        points_text().alias("ma_points_2026_str"),
        reason_for_no_points().alias("reason_for_no_points"),
    )
    return rows.select(*columns) if columns else rows
