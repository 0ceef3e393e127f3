"""Aggregations and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators import checks
from ..operators.groups import is_hot, robust_means
from ..operators.joins import latest_on_or_before
from ..plans import penalties, points, registrations, slots, standings, windows
from . import sql
from .joining import RESIDUALS, placed, residual_rows, stand_in
from .registry import query, rounded, rounded_sql
from .scalars import _model_base, contributing, scored


@query(
    """SELECT w.penalty_list_season, w.penalty_list_date, w.series, max(i.race_season) AS most_recent_race_season_in_window
FROM all_windows w LEFT JOIN in_window i USING (penalty_list_season, penalty_list_date, series) GROUP BY ALL""",
    sql.WINDOWS,
)
def agg_max_season(fx: Fixtures) -> DataFrame:
    every = windows.penalty_windows(fx.publications, fx.contribution_windows)
    table = windows.with_newest_season(every, fx.dim_races)
    return table.select("penalty_list_season", "penalty_list_date", "series", "most_recent_race_season_in_window")


@query("SELECT race_date, penalty_list_date FROM lists", sql.FLAGGED)
def agg_asof_max(fx: Fixtures) -> DataFrame:
    return latest_on_or_before(fx.dim_results, "race_date", fx.stand_in_penalties, "penalty_list_date")


@query(
    "SELECT race_id, gender, "
    + sql.per_vintage("podium_@v.penalty AS race_penalty_@v, " + rounded_sql("podium_@v.minutes", "race_penalty_time_@v", 9))
    + " FROM podium_25 FULL JOIN podium_26 USING (race_id, gender)",
    sql.PENALTIES,
)
def agg_geomean(fx: Fixtures) -> DataFrame:
    table = points.race_penalties(placed(fx), fx.dim_races)
    table = table.filter("race_penalty_25 IS NOT NULL OR race_penalty_26 IS NOT NULL")
    times = [rounded(f"race_penalty_time_{v}", 9) for v in sql.VINTAGES]
    return table.select("race_id", "gender", "race_penalty_25", "race_penalty_26", *times)


@query("SELECT result_id, penaltied_athlete_count_25, penaltied_athlete_count_26 FROM placed", sql.PLACED)
def agg_count_filter_window(fx: Fixtures) -> DataFrame:
    rows = points.results_with_penalties(fx.dim_results, fx.stand_in_penalties, fx.dim_registrations)
    rows = points.with_penaltied_counts(rows, spread=is_hot(fx.dim_results, points.RACE))
    return rows.select("result_id", "penaltied_athlete_count_25", "penaltied_athlete_count_26")


@query(
    """SELECT a.registration_id, a.technique, a.race_name AS name_25, a.points AS points_25, b.race_name AS name_26, b.points AS points_26
FROM maq_25 a JOIN maq_26 b ON b.registration_id = a.registration_id AND b.technique = a.technique""",
    sql.SLOTS,
)
def agg_maq_first(fx: Fixtures) -> DataFrame:
    table = slots.qualifier_results(slots.points_results(scored(fx, *slots.READ)))
    chosen = [
        F.col(f"maq_{v}")[field].alias(f"{name}_{v}")
        for v in sql.VINTAGES
        for field, name in (("race_name", "name"), ("points", "points"))
    ]
    return table.select("registration_id", "technique", *chosen)


@query(
    """SELECT registration_id, athlete_name, race_season, technique FROM scored WHERE registration_id IS NOT NULL
  AND (race_penalty_25 IS NOT NULL OR race_penalty_26 IS NOT NULL) GROUP BY ALL""",
    sql.POINTS,
)
def agg_group_by_all(fx: Fixtures) -> DataFrame:
    return slots.scored_techniques(scored(fx, *slots.READ))


@query(
    "SELECT registration_id, technique, "
    + sql.per_vintage(rounded_sql("technique_points_@v", "technique_points_@v", 7))
    + " FROM by_technique",
    sql.STANDINGS,
)
def agg_weighted_avg(fx: Fixtures) -> DataFrame:
    table = standings.technique_points(contributing(fx))
    return table.select("registration_id", "technique", *[rounded(f"technique_points_{v}", 7) for v in sql.VINTAGES])


@query(
    "SELECT registration_id, technique, finisher_25 AS is_maq_finisher_25, finisher_26 AS is_maq_finisher_26 FROM by_technique",
    sql.STANDINGS,
)
def agg_bool_or(fx: Fixtures) -> DataFrame:
    table = standings.technique_points(contributing(fx))
    return table.select("registration_id", "technique", "is_maq_finisher_25", "is_maq_finisher_26")


LATEST = ["athlete_name", "gender", "school", "club", "city_town", "state", "nensa_number", "usss_number", "birth_year"]


@query(
    "SELECT athlete_id, "
    + ", ".join(f"(list({c} ORDER BY race_season DESC) FILTER ({c} IS NOT NULL))[1] AS {c}" for c in LATEST)
    + " FROM dim_registrations WHERE NOT is_ghost_registration GROUP BY athlete_id"
)
def agg_latest_non_null(fx: Fixtures) -> DataFrame:
    rows = registrations.without_ghosts(fx.dim_registrations)
    return registrations.latest_known(rows).select("athlete_id", *LATEST)


@query(
    """SELECT athlete_id, max(race_season) + 12 - (list(grade ORDER BY race_season DESC) FILTER (grade IS NOT NULL))[1] AS graduation_year
FROM dim_registrations WHERE NOT is_ghost_registration GROUP BY athlete_id"""
)
def graduation_year(fx: Fixtures) -> DataFrame:
    return registrations.dim_athletes(fx.dim_registrations).select("athlete_id", "graduation_year")


@query(
    f"""SELECT penalty_list_season, penalty_list_date, gender, {rounded_sql('avg(p)', 'robust_mean', 7)}
FROM (SELECT q.penalty_list_season, s.penalty_list_date, gender, standardized_athlete_penalty_26 AS p,
    quantile_cont(standardized_athlete_penalty_26, 0.25) OVER w AS lo, quantile_cont(standardized_athlete_penalty_26, 0.75) OVER w AS hi
  FROM stand_in_penalties s JOIN publications q ON q.penalty_list_date = s.penalty_list_date
  WINDOW w AS (PARTITION BY q.penalty_list_season, s.penalty_list_date, gender)) t
WHERE p BETWEEN lo AND hi GROUP BY ALL"""
)
def agg_robust_mean(fx: Fixtures) -> DataFrame:
    column = "standardized_athlete_penalty_26"
    means = robust_means(stand_in(fx), penalties.LIST, column, "robust_mean", (0.25, 0.75))
    return means.select(*penalties.LIST, rounded("robust_mean", 7))


@query(
    "SELECT penalty_list_season, penalty_list_date, gender, athlete_id, n_races, "
    + rounded_sql("resid_mean", "resid_mean", 7)
    + ", "
    + rounded_sql("resid_std", "resid_std", 7)
    + " FROM stats",
    RESIDUALS,
)
def agg_residual_stats(fx: Fixtures) -> DataFrame:
    keys = [*penalties.LIST, "athlete_id"]
    rows = penalties.with_residual_stats(residual_rows(fx), "initial_residual", spread=True)
    rows = rows.groupBy(*keys, "n_races").agg(F.max("resid_mean").alias("resid_mean"), F.max("resid_std").alias("resid_std"))
    return rows.select(*keys, "n_races", rounded("resid_mean", 7), rounded("resid_std", 7))


@query("SELECT penalty_list_season, penalty_list_date, gender, athlete_id FROM model_rows GROUP BY ALL", sql.MODEL_ROWS)
def agg_distinct_keys(fx: Fixtures) -> DataFrame:
    return _model_base(fx).select(*penalties.LIST, "athlete_id").distinct()


@query(
    f"""SELECT penalty_list_season, penalty_list_date, gender, race_id, athlete_id, bool_or(is_outlier_race) AS is_outlier_race,
  {rounded_sql('min(residual)', 'initial_residual', 7)} FROM flagged_races GROUP BY ALL""",
    RESIDUALS,
)
def agg_diag_dedup(fx: Fixtures) -> DataFrame:
    rows = penalties.with_outlier_flag(residual_rows(fx)).withColumn("adjusted_residual", F.col("initial_residual"))
    table = penalties.diagnostics_by_key(rows)
    return table.select(*penalties.DIAGNOSTIC_KEY, "is_outlier_race", rounded("initial_residual", 7))


# The checks find nothing in clean data, so they run on keys that do repeat.
@query(
    """SELECT race_id, gender, count(*) AS n_rows FROM dim_results GROUP BY race_id, gender HAVING count(*) <> 1"""
)
def check_unique(fx: Fixtures) -> DataFrame:
    return checks.not_one_row(fx.dim_results, ["race_id", "gender"])


@query("SELECT series, race_season, count(DISTINCT race_id) AS n_values FROM dim_results GROUP BY series, race_season HAVING count(DISTINCT race_id) > 1")
def check_several_values(fx: Fixtures) -> DataFrame:
    return checks.several_values(fx.dim_results, ["series", "race_season"], "race_id")


@query(
    """SELECT count(*) AS n_races, max(race_date) AS latest_race_date, string_agg(DISTINCT series, ',' ORDER BY series) AS affected_series
FROM dim_races WHERE race_date > (SELECT max(penalty_list_date) FROM publications) + INTERVAL 3 MONTH"""
)
def check_staleness(fx: Fixtures) -> DataFrame:
    return checks.staleness_report(fx.dim_races, fx.publications, 3)


