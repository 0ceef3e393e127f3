"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..functions import text
from ..operators import checks
from ..operators.groups import is_hot
from ..operators.joins import replace_by_lookup, spelling_lookup
from ..plans import penalties, points, results, slots, staging, standings, windows
from . import sql
from .registry import query, rounded, rounded_sql
from .rows import NEEDED, RESOLVED, resolved
from .scalars import NAMED_SQL, _model_base, contributing, scored, scored_table


@query("SELECT result_id, r.race_id, m.race_date, m.race_season, m.series FROM dim_results r LEFT JOIN dim_races m USING (race_id)")
def join_results_races(fx: Fixtures) -> DataFrame:
    rows = fx.dim_results.select("result_id", "race_id")
    return results.with_race(rows, fx.dim_races)


@query("SELECT race_id, gender, sheet_name, source_file_id FROM resolved", RESOLVED)
def join_resolve_files(fx: Fixtures) -> DataFrame:
    return resolved(fx).select("race_id", "gender", "sheet_name", "source_file_id")


@query(
    """SELECT penalty_list_season, penalty_list_date, series, contributing_window_weeks,
  current_season_supplants_previous_season AS recent_season_only FROM publications, contribution_windows"""
)
def join_window_cross(fx: Fixtures) -> DataFrame:
    return windows.penalty_windows(fx.publications, fx.contribution_windows).drop("window_start_date")


@query("SELECT penalty_list_season, penalty_list_date, series, race_id, race_date, race_season FROM in_window", sql.WINDOWS)
def join_races_in_window(fx: Fixtures) -> DataFrame:
    every = windows.penalty_windows(fx.publications, fx.contribution_windows)
    races = fx.dim_races.select("series", "race_id", "race_date", "race_season")
    table = windows.races_in_windows(races, every)
    return table.select("penalty_list_season", "penalty_list_date", "series", "race_id", "race_date", "race_season")


@query("SELECT result_id, race_date, penalty_list_date FROM dim_results JOIN lists USING (race_date)", sql.FLAGGED)
def join_asof_penalty_list(fx: Fixtures) -> DataFrame:
    rows = points.with_penalty_list_date(fx.dim_results, fx.stand_in_penalties)
    return rows.select("result_id", "race_date", "penalty_list_date")


@query("SELECT result_id, penalty_list_date, athlete_penalty_25, athlete_penalty_26 FROM flagged", sql.FLAGGED)
def join_penalties(fx: Fixtures) -> DataFrame:
    rows = points.with_penalty_list_date(fx.dim_results, fx.stand_in_penalties)
    rows = points.with_penalties(rows, fx.stand_in_penalties)
    return rows.select("result_id", "penalty_list_date", "athlete_penalty_25", "athlete_penalty_26")


@query(
    """SELECT result_id, registration_id, is_ghost_registration FROM dim_results r
LEFT JOIN dim_registrations g ON g.athlete_id = r.athlete_id AND g.race_season = r.race_season"""
)
def join_registrations(fx: Fixtures) -> DataFrame:
    rows = points.with_registration(fx.dim_results, fx.dim_registrations)
    return rows.select("result_id", "registration_id", "is_ghost_registration")


def placed(fx: Fixtures) -> DataFrame:
    rows = points.results_with_penalties(fx.dim_results, fx.stand_in_penalties, fx.dim_registrations)
    hot = is_hot(fx.dim_results, points.RACE)
    return points.with_penaltied_places(points.with_penaltied_counts(rows, spread=hot), spread=hot)


@query(
    "SELECT m.race_id, m.race_season, g.gender, podium_25.penalty AS race_penalty_25, podium_26.penalty AS race_penalty_26, "
    + sql.per_vintage(rounded_sql("podium_@v.minutes", "race_penalty_time_@v", 9))
    + " FROM dim_races m CROSS JOIN (SELECT unnest(['b', 'g']) AS gender) g "
    + sql.per_vintage("LEFT JOIN podium_@v ON podium_@v.race_id = m.race_id AND podium_@v.gender = g.gender", " "),
    sql.PENALTIES,
)
def join_races_x_genders(fx: Fixtures) -> DataFrame:
    table = points.race_penalties(placed(fx), fx.dim_races)
    times = [rounded(f"race_penalty_time_{v}", 9) for v in sql.VINTAGES]
    return table.select("race_id", "race_season", "gender", "race_penalty_25", "race_penalty_26", *times)


@query(
    """SELECT race_id, series, is_point_generating = 'true' AS is_point_generating_race, compression_factor_di, compression_factor_sp
FROM dim_races LEFT JOIN point_series USING (series)"""
)
def join_series_config(fx: Fixtures) -> DataFrame:
    races = fx.dim_races.select("race_id", "series")
    return races.join(points.series_config(fx.point_series), "series", "left")


@query("SELECT penalty_list_season, penalty_list_date, race_id, race_date, series, gender, athlete_id, time_float FROM model_rows", sql.MODEL_ROWS)
def join_window_results(fx: Fixtures) -> DataFrame:
    return _model_base(fx).drop("athlete_name")


@query("SELECT penalty_list_season, penalty_list_date, race_id, gender, athlete_id, reference_athlete_id FROM model_rows", sql.MODEL_ROWS)
def join_reference(fx: Fixtures) -> DataFrame:
    rows = penalties.with_winner(_model_base(fx))
    keys = ["penalty_list_season", "penalty_list_date", "race_id", "gender", "athlete_id"]
    return rows.select(*keys, "reference_athlete_id")


@query(
    """SELECT DISTINCT m.penalty_list_season, m.penalty_list_date, m.gender, m.athlete_id, g.athlete_name, g.school, g.club, g.city_town,
  g.state, g.usss_age, g.grade, g.is_ehs_eligible, g.is_u16c_eligible
FROM model_rows m LEFT JOIN dim_registrations g ON g.race_season = m.penalty_list_season AND g.athlete_id = m.athlete_id""",
    sql.MODEL_ROWS,
)
def join_penalty_attributes(fx: Fixtures) -> DataFrame:
    return penalties.penalty_targets(_model_base(fx), fx.dim_registrations)


def stand_in(fx: Fixtures) -> DataFrame:
    """The stand-in penalties with a season, as a fitted table would have."""
    return fx.stand_in_penalties.join(fx.publications, "penalty_list_date")


@query(
    """SELECT m.penalty_list_season, m.penalty_list_date, m.gender, m.athlete_id, p.standardized_athlete_penalty_25 AS athlete_penalty_25
FROM (SELECT DISTINCT penalty_list_season, penalty_list_date, gender, athlete_id FROM model_rows) m
LEFT JOIN stand_in_penalties p ON p.penalty_list_date = m.penalty_list_date AND p.gender = m.gender AND p.athlete_id = m.athlete_id""",
    sql.MODEL_ROWS,
)
def join_align_penalties(fx: Fixtures) -> DataFrame:
    keys = [*penalties.LIST, "athlete_id"]
    targets = _model_base(fx).select(*keys).distinct()
    fitted = stand_in(fx).withColumnRenamed("standardized_athlete_penalty_25", "athlete_penalty_25")
    return penalties.align_penalties(targets, fitted.select(*keys, "athlete_penalty_25"))


# Residuals that SQL can express: log time against the athlete's mean on the list.
RESIDUALS = (
    sql.MODEL_ROWS
    + """, resid AS (SELECT *, log_time - avg(log_time) OVER (PARTITION BY penalty_list_season, penalty_list_date, gender, athlete_id)
    AS residual FROM model_rows),
stats AS (SELECT penalty_list_season, penalty_list_date, gender, athlete_id, count(*) AS n_races, avg(residual) AS resid_mean,
    stddev_samp(residual) AS resid_std FROM resid GROUP BY ALL),
flagged_races AS (SELECT r.*, s.n_races >= 5 AND s.resid_std > 0 AND r.residual > s.resid_mean + 2 * s.resid_std AS is_outlier_race
  FROM resid r JOIN stats s USING (penalty_list_season, penalty_list_date, gender, athlete_id))"""
)


def residual_rows(fx: Fixtures) -> DataFrame:
    rows = penalties.with_log_features(penalties.with_winner(_model_base(fx)))
    mean = rows.groupBy(*penalties.LIST, "athlete_id").agg(F.avg("log_time").alias("_mean"))
    rows = rows.join(mean, [*penalties.LIST, "athlete_id"])
    return rows.withColumn("initial_residual", F.col("log_time") - F.col("_mean")).drop("_mean")


@query(
    f"""SELECT m.penalty_list_season, m.penalty_list_date, m.race_id, m.gender, m.athlete_id,
  coalesce(f.is_outlier_race, false) AS is_outlier_race, {rounded_sql('f.residual', 'initial_residual', 7)}
FROM model_rows m LEFT JOIN (SELECT * FROM flagged_races WHERE series <> 'EC') f
  USING (penalty_list_season, penalty_list_date, race_id, gender, athlete_id)""",
    RESIDUALS,
)
def join_diagnostics(fx: Fixtures) -> DataFrame:
    rows = _model_base(fx)
    flagged = penalties.with_outlier_flag(residual_rows(fx)).withColumn("adjusted_residual", F.col("initial_residual"))
    flagged = flagged.filter("series <> 'EC'")  # rows without diagnostics are part of the join
    table = penalties.with_diagnostics(rows, penalties.diagnostics_by_key(flagged))
    keys = ["penalty_list_season", "penalty_list_date", "race_id", "gender", "athlete_id"]
    return table.select(*keys, "is_outlier_race", rounded("initial_residual", 7))


@query(
    f"""SELECT registration_id, technique, {sql.SLOT_NAMES} AS description, contributing_race_name_25, contributing_race_points_25,
  contributing_race_name_26, contributing_race_points_26 FROM slots WHERE slot > 0""",
    sql.SLOTS.rsplit(", contributing AS", 1)[0],
)
def join_slots(fx: Fixtures) -> DataFrame:
    table = scored_table(fx)
    rows = slots.points_results(table)
    others = slots.other_slots(table, slots.qualifier_results(rows), slots.best_by_slot(rows))
    kinds = [f"contributing_race_{c}_{v}" for v in sql.VINTAGES for c in ("name", "points")]
    return others.select("registration_id", "technique", "description", *kinds)


@query(
    """SELECT registration_id, technique, athlete_name, race_season, contributing_race_name_25, maq_points_25, contributing_race_name_26,
  maq_points_26 FROM slots WHERE slot = 0""",
    sql.SLOTS.rsplit(", contributing AS", 1)[0],
)
def join_maq(fx: Fixtures) -> DataFrame:
    rows = slots.points_results(scored(fx, *slots.READ))
    table = slots.qualifier_slots(fx.dim_registrations, slots.qualifier_results(rows))
    kinds = [f"{c}_{v}" for v in sql.VINTAGES for c in ("contributing_race_name", "maq_points")]
    return table.select("registration_id", "technique", "athlete_name", "race_season", *kinds)


@query("SELECT registration_id, cl_points_25, cl_points_26, sk_points_25, sk_points_26 FROM totals", sql.STANDINGS)
def join_techniques(fx: Fixtures) -> DataFrame:
    wide = standings.by_technique(contributing(fx))
    rows = fx.dim_registrations.select("registration_id").join(wide, "registration_id", "left")
    return rows.select("registration_id", *[f"{t}_points_{v}" for t in ("cl", "sk") for v in sql.VINTAGES])


@query("SELECT sheet_name, source_file_id FROM inventory WHERE sheet_name NOT IN (SELECT sheet_name FROM needed)", NEEDED)
def anti_join_orphans(fx: Fixtures) -> DataFrame:
    needed = staging.needed_sheets(staging.dim_races(fx.race_list))
    return checks.unreferenced_files(fx.inventory, needed).select("sheet_name", "source_file_id")


@query("SELECT DISTINCT series FROM dim_races WHERE series NOT IN (SELECT series FROM contribution_windows)")
def anti_join_series(fx: Fixtures) -> DataFrame:
    return checks.series_without_window(fx.dim_races, fx.contribution_windows)


LATEST_SPELLING = "spelled AS (SELECT variant, arg_max(canonical, line) AS canonical FROM name_spellings GROUP BY variant)"


@query(
    "SELECT race_id, usss_id, coalesce(s.canonical, n.athlete_name) AS athlete_name FROM named n LEFT JOIN spelled s ON s.variant = n.athlete_name",
    NAMED_SQL + ", " + LATEST_SPELLING,
)
def map_replace(fx: Fixtures) -> DataFrame:
    name = text.title_case(text.clean_name(F.col("name_raw")))
    rows = fx.staged.select("race_id", "usss_id", name.alias("athlete_name"))
    lookup = spelling_lookup(fx.name_spellings, "canonical", "variant", "line")
    return replace_by_lookup(rows, "athlete_name", lookup)


