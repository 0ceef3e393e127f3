"""Athlete penalties: both methods over every penalty list at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    ATHLETE_ATTRIBUTES,
    OUTLIER_MIN_RACES,
    OUTLIER_SIGMA,
    ROBUST_PERCENTILES,
    TARGET_MEAN,
    WINDOW_COLUMNS,
)
from ..operators.groups import is_hot, robust_means, with_group_stats, with_rank
from ..operators.least_squares import fit_race_effects, fit_winner_differences
from ..session import durable

LIST = ["penalty_list_season", "penalty_list_date", "gender"]
LIST_RACE = ["penalty_list_date", "race_id", "gender"]
DIAGNOSTIC_KEY = [*LIST, "race_id", "athlete_id"]


# --- rows the models see -----------------------------------------------------------------


def registered_window_results(
    registrations: DataFrame, results: DataFrame, races_by_window: DataFrame
) -> DataFrame:
    """Results with a finite time of window races, by athletes registered in the list's season (ghosts included)."""
    races = races_by_window.select("penalty_list_season", "penalty_list_date", "race_id", "series")
    timed = results.filter("abs(time_float) < double('infinity')").select(
        "race_id", "athlete_id", "athlete_name", "race_date", "gender", "time_float"
    )
    registered = registrations.select(F.col("race_season").alias("penalty_list_season"), "athlete_id")
    return races.join(timed, "race_id").join(registered, ["penalty_list_season", "athlete_id"])


def with_winner(rows: DataFrame) -> DataFrame:
    """Fastest of the list date, race and gender; a tie goes to the smallest athlete id.

    A grouped minimum joined back, not a window: the minimum combines before the shuffle.
    """
    winner = F.min(F.struct("time_float", "athlete_id"))
    best = rows.groupBy(*LIST_RACE).agg(winner.alias("_w")).select(
        *LIST_RACE,
        F.col("_w.time_float").alias("reference_time_float"),
        F.col("_w.athlete_id").alias("reference_athlete_id"),
    )
    return rows.join(durable(best, "winners"), LIST_RACE, "left")


def with_log_features(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "log_time": F.ln("time_float"),
            "time_log_ratio": F.ln(F.try_divide("time_float", "reference_time_float")),
            "days_from_race_to_publication": F.datediff("penalty_list_date", "race_date").cast("bigint"),
        }
    )


def with_athlete_place(rows: DataFrame) -> DataFrame:
    """Place among the registered athletes of the race, a diagnostic that is not published."""
    spread = is_hot(rows, LIST_RACE)
    return with_rank(rows, LIST_RACE, "time_float", "ma_athlete_place", spread=spread)


def results_by_penalty_window(
    registrations: DataFrame, results: DataFrame, races_by_window: DataFrame
) -> DataFrame:
    rows = registered_window_results(registrations, results, races_by_window)
    rows = durable(rows, "registered-results")  # read for the winners and again for the rows
    return with_log_features(with_winner(rows)).select(*WINDOW_COLUMNS)


def penalty_targets(window_results: DataFrame, registrations: DataFrame) -> DataFrame:
    """Every list and athlete that needs a penalty, with the registration's attributes."""
    keys = window_results.select(*LIST, "athlete_id").distinct()
    attributes = registrations.select(
        F.col("race_season").alias("penalty_list_season"), "athlete_id", *ATHLETE_ATTRIBUTES
    )
    return keys.join(attributes, ["penalty_list_season", "athlete_id"], "left").select(
        *LIST, "athlete_id", *ATHLETE_ATTRIBUTES
    )


# --- scaling ---------------------------------------------------------------------------------


def scale_to_target(penalties: DataFrame, column: str, target: float = TARGET_MEAN) -> DataFrame:
    """Scale each list so that the mean of its middle half is ``target``."""
    means = robust_means(penalties, LIST, column, "_mean", ROBUST_PERCENTILES)
    usable = F.col("_mean").isNotNull() & (F.col("_mean") != 0) & (F.abs("_mean") < float("inf"))
    scaled = F.when(usable, F.col(column) * (F.lit(target) / F.col("_mean"))).otherwise(F.col(column))
    return penalties.join(means, LIST, "left").withColumn(column, scaled).drop("_mean")


def first_date_cohort(penalties: DataFrame) -> DataFrame:
    """Athletes on the first list of each season and gender."""
    season = ["penalty_list_season", "gender"]
    first = penalties.groupBy(*season).agg(F.min("penalty_list_date").alias("penalty_list_date"))
    return penalties.join(first, LIST, "left_semi").select(*season, "athlete_id").distinct()


def standardize_cohort(
    penalties: DataFrame, column: str, out: str, target: float = TARGET_MEAN
) -> DataFrame:
    """Rescale each list by the cohort that was already on the season's first list."""
    present = penalties.filter(F.col(column).isNotNull())
    cohort = first_date_cohort(present)
    members = present.join(cohort, ["penalty_list_season", "gender", "athlete_id"], "left_semi")
    means = robust_means(members, LIST, column, "_mean", ROBUST_PERCENTILES)
    factor = F.try_divide(F.lit(target), F.col("_mean"))
    return penalties.join(means, LIST, "left").withColumn(out, factor * F.col(column)).drop("_mean")


def finished_penalties(effects: DataFrame, vintage: str) -> DataFrame:
    """Log effects to scaled and standardised penalties."""
    column = f"athlete_penalty_{vintage}"
    raw = effects.select(*LIST, "athlete_id", F.exp("effect").alias(column))
    scaled = durable(scale_to_target(raw, column), f"penalties-{vintage}")
    return standardize_cohort(scaled, column, f"standardized_{column}")


# --- winner-difference model (vintage 25) ------------------------------------------------------


def fit_2025(window_results: DataFrame) -> DataFrame:
    """Log effect per list and athlete from log ratios to the winner; winners' own rows left out."""
    behind = window_results.filter(F.col("athlete_id") != F.col("reference_athlete_id"))
    rows = behind.select(
        *LIST, "athlete_id", "reference_athlete_id", F.col("time_log_ratio").alias("y")
    )
    return durable(fit_winner_differences(rows.filter("y IS NOT NULL"), LIST), "fit-2025")


def penalties_2025(window_results: DataFrame) -> DataFrame:
    return finished_penalties(fit_2025(window_results), "25")


# --- race-and-athlete model (vintage 26) --------------------------------------------------------


def fit_2026(rows: DataFrame) -> DataFrame:
    """Race and athlete effects on the log time: LIST, kind, node, effect."""
    observed = rows.filter("log_time IS NOT NULL").select(
        *LIST, "race_id", "athlete_id", F.col("log_time").alias("y")
    )
    return durable(fit_race_effects(observed, LIST), "fit-2026")


def with_residual(rows: DataFrame, effects: DataFrame, out: str) -> DataFrame:
    """Observed minus fitted log time; NULL when the race or the athlete has no effect."""
    for kind in ("race", "athlete"):
        side = effects.filter(F.col("kind") == kind).select(
            *LIST, F.col("node").alias(f"{kind}_id"), F.col("effect").alias(f"_{kind}")
        )
        rows = rows.join(side, [*LIST, f"{kind}_id"], "left")
    residual = F.col("log_time") - (F.col("_race") + F.col("_athlete"))
    return rows.withColumn(out, residual).drop("_race", "_athlete")


def with_residual_stats(rows: DataFrame, residual: str, *, spread: bool) -> DataFrame:
    """Count, mean and sample deviation of the athlete's residuals on the list."""
    value = F.col(residual)
    stats = {
        "n_races": F.count(F.lit(1)),
        "resid_mean": F.avg(value),
        "resid_std": F.stddev_samp(value),
    }
    return with_group_stats(rows, [*LIST, "athlete_id"], stats, spread=spread)


def with_outlier_flag(
    rows: DataFrame,
    residual: str = "initial_residual",
    *,
    min_races: int = OUTLIER_MIN_RACES,
    sigma: float = OUTLIER_SIGMA,
    spread: bool | None = None,
) -> DataFrame:
    """Races in which an athlete with enough of them was unusually slow."""
    if spread is None:
        spread = is_hot(rows, [*LIST, "athlete_id"])
    rows = with_residual_stats(rows, residual, spread=spread)
    slow = F.col(residual) > F.col("resid_mean") + sigma * F.col("resid_std")
    flag = (F.col("n_races") >= min_races) & (F.col("resid_std") > 0) & slow
    return rows.withColumn("is_outlier_race", F.coalesce(flag, F.lit(False))).drop(
        "n_races", "resid_mean", "resid_std"
    )


def fit_2026_twice(window_results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(athlete effects of the second fit, rows with outlier flag and both residuals).

    The second fit leaves the outliers out. A list cannot lose all its rows to that, because not
    every residual of an athlete can lie above the mean.
    """
    rows = window_results.select(*DIAGNOSTIC_KEY, "log_time").filter("log_time IS NOT NULL")
    spread = is_hot(rows, [*LIST, "athlete_id"])
    rows = with_residual(rows, fit_2026(rows), "initial_residual")
    if spread:
        rows = durable(rows, "residuals")
    rows = durable(with_outlier_flag(rows, spread=spread), "outliers")
    refit = fit_2026(rows.filter("NOT is_outlier_race"))
    athletes = refit.filter("kind = 'athlete'").select(*LIST, F.col("node").alias("athlete_id"), "effect")
    return athletes, with_residual(rows, refit, "adjusted_residual")


def diagnostics_by_key(rows: DataFrame) -> DataFrame:
    """One row per key: any outlier, and one of the known residuals."""
    return rows.groupBy(*DIAGNOSTIC_KEY).agg(
        F.bool_or("is_outlier_race").alias("is_outlier_race"),
        F.min("initial_residual").alias("initial_residual"),
        F.min("adjusted_residual").alias("adjusted_residual"),
    )


def with_diagnostics(window_results: DataFrame, diagnostics: DataFrame) -> DataFrame:
    rows = window_results.join(diagnostics, DIAGNOSTIC_KEY, "left")
    flag = F.coalesce("is_outlier_race", F.lit(False))
    columns = [*window_results.columns, "is_outlier_race", "initial_residual", "adjusted_residual"]
    return rows.withColumn("is_outlier_race", flag).select(*columns)


def penalties_2026(window_results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with diagnostics, penalties)."""
    athletes, rows = fit_2026_twice(window_results)
    diagnosed = with_diagnostics(window_results, diagnostics_by_key(rows))
    return diagnosed, finished_penalties(athletes, "26")


def align_penalties(targets: DataFrame, *penalties: DataFrame) -> DataFrame:
    """Fitted penalties on the target rows; an athlete without a fit gets NULL."""
    for fitted in penalties:
        targets = targets.join(fitted, [*LIST, "athlete_id"], "left")
    return targets


def build_penalties(
    registrations: DataFrame, results: DataFrame, races_by_window: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(ext_results_by_penalty_window, ext_athlete_penalties)."""
    rows = durable(results_by_penalty_window(registrations, results, races_by_window), "window-results")
    targets = penalty_targets(rows, registrations)
    pen_25 = penalties_2025(rows)
    diagnosed, pen_26 = penalties_2026(rows)
    columns = [f"{prefix}athlete_penalty_{v}" for v in ("25", "26") for prefix in ("", "standardized_")]
    aligned = align_penalties(targets, pen_25, pen_26)
    return diagnosed, aligned.select(*targets.columns, *columns)
