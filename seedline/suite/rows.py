"""Projection, filters, reshaping, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import GHOST_CATEGORY
from ..fixtures import Fixtures
from ..plans import points, registrations, slots, staging, windows
from . import sql
from .registry import query
from .scalars import contributing, scored

EDIT = "'https://docs.google.com/spreadsheets/d/' || source_file_id || '/edit'"
CSV = "'https://docs.google.com/spreadsheets/d/' || source_file_id || '/gviz/tq?tqx=out:csv'"
NEEDED = """needed AS (SELECT race_id, 'b' AS gender, trim(boys_results_name) AS sheet_name FROM race_list WHERE trim(boys_results_name) <> ''
  UNION ALL SELECT race_id, 'g', trim(girls_results_name) FROM race_list WHERE trim(girls_results_name) <> '')"""
RESOLVED = NEEDED + ", resolved AS (SELECT n.*, i.source_file_id, i.modified_at FROM needed n LEFT JOIN inventory i USING (sheet_name))"


RACES_SQL = """SELECT race_id, CAST(TRY_CAST(date AS TIMESTAMP) AS DATE) AS race_date, race_season, name AS race_name, series, technique,
  discipline, format AS race_format, division, venue, state, CAST(NULL AS VARCHAR) AS results_pdf_url_b,
  CAST(NULL AS VARCHAR) AS results_pdf_url_g, boys_results_name AS prep_results_table_b, girls_results_name AS prep_results_table_g
FROM race_list"""


@query(RACES_SQL)
def build_dim_races(fx: Fixtures) -> DataFrame:
    return staging.dim_races(fx.race_list)


@query(
    """SELECT * EXCLUDE place FROM (SELECT *, row_number() OVER (PARTITION BY race_season, series ORDER BY md5('7,' || race_id)) AS place
  FROM dim_races) WHERE place = 1"""
)
def dev_sample(fx: Fixtures) -> DataFrame:
    return staging.dev_sample(fx.dim_races, seed=7)


@query("SELECT race_id, gender, sheet_name FROM needed", NEEDED)
def unpivot_needed_sheets(fx: Fixtures) -> DataFrame:
    return staging.needed_sheets(staging.dim_races(fx.race_list))


def resolved(fx: Fixtures) -> DataFrame:
    return staging.resolve_sheets(staging.needed_sheets(staging.dim_races(fx.race_list)), fx.inventory)


@query(
    f"""SELECT r.race_id, b.url AS prep_results_url_b, g.url AS prep_results_url_g FROM race_list r
LEFT JOIN (SELECT race_id, {EDIT} AS url FROM resolved WHERE gender = 'b') b ON b.race_id = r.race_id
LEFT JOIN (SELECT race_id, {EDIT} AS url FROM resolved WHERE gender = 'g') g ON g.race_id = r.race_id""",
    RESOLVED,
)
def pivot_urls(fx: Fixtures) -> DataFrame:
    races = staging.with_result_urls(staging.dim_races(fx.race_list), resolved(fx))
    return races.select("race_id", "prep_results_url_b", "prep_results_url_g")


SEASONS = range(2020, 2028)


@query(
    "SELECT athlete_id, "
    + ", ".join(f"bool_or(race_season = {s}) AS was_registered_eligible_{s}" for s in SEASONS)
    + " FROM dim_registrations WHERE NOT is_ghost_registration GROUP BY athlete_id"
)
def pivot_registered_seasons(fx: Fixtures) -> DataFrame:
    return registrations.registered_seasons(registrations.without_ghosts(fx.dim_registrations))


@query(
    f"SELECT race_id, gender, source_file_id, {EDIT} AS prep_results_url, {CSV} AS gviz_csv_url FROM resolved", RESOLVED
)
def derive_urls(fx: Fixtures) -> DataFrame:
    return resolved(fx).select("race_id", "gender", "source_file_id", "prep_results_url", "gviz_csv_url")


@query(
    f"""SELECT last_name, race_season, category, coalesce({sql.ELIGIBLE}, false) AS is_eligible,
  coalesce(category = {sql.text(GHOST_CATEGORY)}, false) AS is_ghost FROM staged_registrations"""
)
def category_filter(fx: Fixtures) -> DataFrame:
    category = F.col("category")
    return fx.staged_registrations.select(
        "last_name",
        "race_season",
        "category",
        registrations.is_eligible_category(category).alias("is_eligible"),
        registrations.is_ghost_category(category).alias("is_ghost"),
    )


@query(
    f"""SELECT registration_id, race_season - 1 - birth_year AS usss_age, coalesce({sql.EHS_GRADE}, false) AS is_ehs_eligible,
  coalesce({sql.U16_AGE}, false) AS is_u16c_eligible FROM dim_registrations
WHERE is_ghost_registration OR coalesce({sql.EHS_GRADE}, false) OR coalesce({sql.U16_AGE}, false)"""
)
def eligibility_flags(fx: Fixtures) -> DataFrame:
    base = fx.dim_registrations.drop("usss_age", "is_ehs_eligible", "is_u16c_eligible")
    rows = registrations.with_eligibility(base)
    rows = rows.filter("is_ghost_registration OR is_ehs_eligible OR is_u16c_eligible")
    return rows.select("registration_id", "usss_age", "is_ehs_eligible", "is_u16c_eligible")


WINDOW_KEY = "penalty_list_season, penalty_list_date, series, race_id"


@query(f"SELECT {WINDOW_KEY} FROM in_window WHERE CASE WHEN recent_season_only THEN race_season = newest ELSE true END", sql.WINDOWS)
def filter_recent_season(fx: Fixtures) -> DataFrame:
    table = windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    return table.select("penalty_list_season", "penalty_list_date", "series", "race_id")


@query("SELECT penalty_list_season, penalty_list_date, series, window_start_date FROM all_windows", sql.WINDOWS)
def window_start(fx: Fixtures) -> DataFrame:
    table = windows.penalty_windows(fx.publications, fx.contribution_windows)
    return table.select("penalty_list_season", "penalty_list_date", "series", "window_start_date")


@query(
    f"""SELECT registration_id, technique, {sql.SLOT_NAMES} AS description, maq_points_25 IS NOT NULL AS is_maq_finisher_25,
  maq_points_26 IS NOT NULL AS is_maq_finisher_26 FROM slots""",
    sql.SLOTS.rsplit(", contributing AS", 1)[0],
)
def slot_flags(fx: Fixtures) -> DataFrame:
    table = contributing(fx)
    return table.select("registration_id", "technique", "description", "is_maq_finisher_25", "is_maq_finisher_26")


@query("SELECT result_id, series <> 'MAQ' AS is_not_maq, race_points_25, race_points_26 FROM eligible", sql.SLOTS)
def points_row_filter(fx: Fixtures) -> DataFrame:
    rows = slots.points_results(scored(fx, *slots.READ))
    return rows.select("result_id", "is_not_maq", "race_points_25", "race_points_26")


@query("SELECT registration_id, athlete_id, race_season FROM dim_registrations WHERE is_ghost_registration IS DISTINCT FROM true")
def non_ghost_filter(fx: Fixtures) -> DataFrame:
    rows = registrations.without_ghosts(fx.dim_registrations)
    return rows.select("registration_id", "athlete_id", "race_season")


@query(
    """SELECT race_id, r.series, CASE is_point_generating WHEN 'true' THEN true WHEN 'false' THEN false END AS is_point_generating_race
FROM dim_races r LEFT JOIN point_series s ON s.series = r.series"""
)
def point_gen_cast(fx: Fixtures) -> DataFrame:
    config = points.series_config(fx.point_series)
    return fx.dim_races.join(config, "series", "left").select("race_id", "series", "is_point_generating_race")


FLAGS = [
    "is_registered_or_ghost_finish",
    "is_registered_finish",
    "is_penaltied_athlete_finish_25",
    "is_penaltied_athlete_finish_26",
]


@query(f"SELECT result_id, {', '.join(FLAGS)} FROM flagged", sql.FLAGGED)
def finish_flags(fx: Fixtures) -> DataFrame:
    rows = points.results_with_penalties(fx.dim_results, fx.stand_in_penalties, fx.dim_registrations)
    return rows.select("result_id", *FLAGS)


@query(
    """SELECT race_id, discipline, coalesce(CASE discipline WHEN 'DI' THEN compression_factor_di WHEN 'SP' THEN compression_factor_sp END, 1)
  AS compression_factor_26 FROM dim_races LEFT JOIN point_series USING (series)"""
)
def compression_factor(fx: Fixtures) -> DataFrame:
    races = fx.dim_races.join(points.series_config(fx.point_series), "series", "left")
    return races.select("race_id", "discipline", points.compression_factor_26().alias("compression_factor_26"))


@query(f"SELECT result_id, {sql.REASON} AS reason_for_no_points FROM scored", sql.POINTS)
def reason_for_no_points(fx: Fixtures) -> DataFrame:
    return scored(fx, "result_id", "reason_for_no_points")


@query(f"SELECT result_id, {sql.POINTS_TEXT} AS ma_points_2026_str FROM scored", sql.POINTS)
def points_string(fx: Fixtures) -> DataFrame:
    return scored(fx, "result_id", "ma_points_2026_str")
