"""Composite tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CLUB_SPELLINGS, CLUBS_MEANING_NONE, GENDER_CODES, GHOST_CATEGORY
from ..fixtures import STAGED_REGISTRATION_NAMES, Fixtures
from ..functions.text import short_hash
from ..operators.joins import spelling_lookup
from ..plans import penalties, registrations, results, season, staging, standings, windows
from ..sources import sheets
from . import sql
from .joining import LATEST_SPELLING
from .models import BOTH
from .registry import query, rounded, rounded_sql
from .rows import NEEDED, RACES_SQL, SEASONS
from .scalars import CLEAN_SQL, FULL_NAME_SQL, GRADE_SQL, SCHOOL_SQL, TIME_SQL, contributing, scored, title_sql
from .sources import write_sheets


STANDARD = """name AS name_raw, time AS time_raw, usss AS usss_id, CAST(NULL AS VARCHAR) AS fis_id,
  CASE WHEN series LIKE 'A%' THEN school END AS school_raw, CAST(NULL AS VARCHAR) AS team_raw, CAST(NULL AS VARCHAR) AS state_raw"""


@query(f"SELECT n.race_id, n.gender, {STANDARD} FROM sheet_rows s JOIN needed n ON n.sheet_name = s.sheet_name", NEEDED)
def stg_results(fx: Fixtures) -> DataFrame:
    root = write_sheets(fx)
    inventory = sheets.file_inventory(fx.spark, root, folders=True)
    staged, _ = staging.staged_results(root, fx.race_list, inventory)
    return staged.drop("source_file_id", "prep_results_url", "created_at")


@query(f"SELECT sheet_name AS race_id, {STANDARD} FROM sheet_rows")
def stg_results_by_file(fx: Fixtures) -> DataFrame:
    """Staging without a race list: every file is a race, and there is no gender."""
    root = write_sheets(fx)
    files = sheets.infra_result_files(sheets.file_inventory(fx.spark, root, folders=True))
    return staging.staged_results_by_file(root, files).drop("file_id", "created_at")


@query(
    """SELECT 'missing' AS problem, race_id, gender, sheet_name FROM needed WHERE sheet_name NOT IN (SELECT sheet_name FROM sheet_rows)
UNION ALL SELECT DISTINCT 'orphaned', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), sheet_name FROM sheet_rows
WHERE sheet_name NOT IN (SELECT sheet_name FROM needed)""",
    NEEDED,
)
def sheet_report(fx: Fixtures) -> DataFrame:
    inventory = sheets.file_inventory(fx.spark, write_sheets(fx), folders=True)
    resolved = staging.resolve_sheets(staging.needed_sheets(staging.dim_races(fx.race_list)), inventory)
    return staging.sheet_report(resolved, inventory).drop("source_file_id")


SPELLED = LATEST_SPELLING + ", schools AS (SELECT variant, canonical FROM school_spellings)"
DIM_RESULTS = (
    SPELLED
    + f""", parsed AS (SELECT s.*, m.race_date, m.race_season, {TIME_SQL} AS minutes,
    CASE WHEN m.series = 'EC' THEN {CLEAN_SQL} ELSE {title_sql(CLEAN_SQL)} END AS cleaned, {title_sql('school_raw')} AS school_title
  FROM staged s LEFT JOIN dim_races m ON m.race_id = s.race_id),
known AS (SELECT p.*, coalesce(v.canonical, p.cleaned) AS known_name, coalesce(h.canonical, p.school_title) AS school
  FROM parsed p LEFT JOIN spelled v ON v.variant = p.cleaned LEFT JOIN schools h ON h.variant = p.school_title),
final AS (SELECT *, known_name IN (SELECT non_person FROM non_people) AS is_unidentified_athlete,
    CASE WHEN known_name IN (SELECT non_person FROM non_people) THEN 'Unidentified Athlete' ELSE known_name END AS athlete_name FROM known)"""
)


RESULT_COLUMNS = """left(sha256(left(sha256(gender || ',' || athlete_name), 12) || ',' || race_id), 12) AS result_id, race_id,
  left(sha256(gender || ',' || athlete_name), 12) AS athlete_id, race_date, race_season, gender,
  CASE WHEN minutes IS NOT NULL THEN rank() OVER (PARTITION BY race_id, gender ORDER BY minutes NULLS LAST) END AS finish_place,
  athlete_name, CASE WHEN minutes IS NULL THEN '' ELSE printf('%02d:%05.2f', CAST(floor(minutes) AS BIGINT), (minutes - floor(minutes)) * 60) END AS time,
  {time} AS time_float, usss_id, fis_id, source_file_id, prep_results_url, is_unidentified_athlete, school,
  team_raw AS team, state_raw AS state"""


@query(f"SELECT {RESULT_COLUMNS.format(time=rounded_sql('minutes', '', 9).removesuffix(' AS '))} FROM final", DIM_RESULTS)
def dim_results(fx: Fixtures) -> DataFrame:
    names = spelling_lookup(fx.name_spellings, "canonical", "variant", "line")
    schools = spelling_lookup(fx.school_spellings, "canonical", "variant", "line")
    table = results.dim_results(fx.staged, fx.dim_races, names, schools, fx.non_people)
    return table.withColumn("time_float", rounded("time_float", 9))


CODE = f"CASE lower(gender) {sql.branches(GENDER_CODES)} ELSE lower(gender) END"
REGISTERED = (
    SPELLED
    + f""", base AS (SELECT *, {FULL_NAME_SQL} AS full_name, {SCHOOL_SQL} AS school_title, {title_sql('school')} AS ghost_school,
    {GRADE_SQL} AS parsed_grade FROM staged_registrations),
both_kinds AS (
  SELECT full_name, school_title, city, state, club, gender, race_season, TRY_CAST(nensa AS BIGINT) AS nensa_number,
    TRY_CAST(usss AS BIGINT) AS usss_number, TRY_CAST(birth_year AS BIGINT) AS birth_year, parsed_grade AS grade, false AS is_ghost_registration
  FROM base WHERE {sql.ELIGIBLE}
  UNION ALL
  SELECT full_name, ghost_school, city, state, club, gender, race_season, NULL, NULL, NULL, NULL, true FROM base WHERE category = {sql.text(GHOST_CATEGORY)}),
named AS (SELECT coalesce(v.canonical, full_name) AS athlete_name, coalesce(h.canonical, school_title) AS school, b.* EXCLUDE (gender),
    {CODE} AS gender FROM both_kinds b LEFT JOIN spelled v ON v.variant = full_name LEFT JOIN schools h ON h.variant = school_title),
aged AS (SELECT *, left(sha256(gender || ',' || athlete_name), 12) AS athlete_id, race_season - 1 - birth_year AS usss_age,
    coalesce({sql.EHS_GRADE}, false) AS is_ehs_eligible, coalesce({sql.U16_AGE}, false) AS is_u16c_eligible FROM named),
registered AS (SELECT left(sha256(athlete_id || ',' || CAST(race_season AS VARCHAR)), 12) AS registration_id, race_season, athlete_id, athlete_name,
    gender, is_ghost_registration, school, CASE WHEN club IN {sql.listed(CLUBS_MEANING_NONE)} THEN NULL
      ELSE CASE club {sql.branches(CLUB_SPELLINGS)} ELSE club END END AS club, {title_sql('city')} AS city_town, upper(state) AS state,
    nensa_number, usss_number, birth_year, grade, usss_age, is_ehs_eligible, is_u16c_eligible
  FROM aged WHERE is_ghost_registration OR is_ehs_eligible OR is_u16c_eligible)"""
)


def registered(fx: Fixtures) -> DataFrame:
    staged = fx.staged_registrations.withColumnsRenamed(STAGED_REGISTRATION_NAMES)
    names = spelling_lookup(fx.name_spellings, "canonical", "variant", "line")
    schools = spelling_lookup(fx.school_spellings, "canonical", "variant", "line")
    return registrations.dim_registrations(staged, names, schools)


@query("SELECT * FROM registered", REGISTERED)
def dim_registrations(fx: Fixtures) -> DataFrame:
    return registered(fx)


@query("SELECT is_ghost_registration, registration_id, school FROM registered", REGISTERED)
def concat_frames(fx: Fixtures) -> DataFrame:
    return registered(fx).select("is_ghost_registration", "registration_id", "school")


LAST = ["athlete_name", "gender", "school", "club", "city_town", "state", "nensa_number", "usss_number", "birth_year"]


@query(
    "SELECT athlete_id, false AS is_ghost_registration, "
    + ", ".join(f"arg_max({c}, race_season) FILTER ({c} IS NOT NULL) AS {c}" for c in LAST)
    + ", max(race_season) + 12 - arg_max(grade, race_season) FILTER (grade IS NOT NULL) AS graduation_year, "
    + ", ".join(f"bool_or(race_season = {s}) AS was_registered_eligible_{s}" for s in SEASONS)
    + " FROM dim_registrations WHERE NOT is_ghost_registration GROUP BY athlete_id"
)
def dim_athletes(fx: Fixtures) -> DataFrame:
    return registrations.dim_athletes(fx.dim_registrations)


@query("SELECT penalty_list_season, penalty_list_date, series, race_id, race_date, race_season FROM window_races", sql.WINDOWS)
def races_by_penalty_window(fx: Fixtures) -> DataFrame:
    return windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)


@query(
    "SELECT "
    + ", ".join(c for c in penalties.WINDOW_COLUMNS if "log" not in c)
    + f", {rounded_sql('log_time', 'log_time', 9)}, {rounded_sql('time_log_ratio', 'time_log_ratio', 9)} FROM model_rows",
    sql.MODEL_ROWS,
)
def results_by_penalty_window(fx: Fixtures) -> DataFrame:
    races = windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    table = penalties.results_by_penalty_window(fx.dim_registrations, fx.dim_results, races)
    return table.withColumns({c: rounded(c, 9) for c in ("log_time", "time_log_ratio")})


IRRATIONAL = [f"{c}_{v}" for c in ("race_penalty_time", "ma_time_penalty_ratio") for v in sql.VINTAGES]


@query(
    f"SELECT * EXCLUDE (list_season, {', '.join(IRRATIONAL)}), "
    + ", ".join(rounded_sql(c, c, 9) for c in IRRATIONAL)
    + f", {sql.SEASON_RANKS}, {sql.POINTS_TEXT} AS ma_points_2026_str, {sql.REASON} AS reason_for_no_points FROM scored",
    sql.POINTS,
)
def ext_results(fx: Fixtures) -> DataFrame:
    return scored(fx).withColumns({c: rounded(c, 9) for c in IRRATIONAL})


@query(
    f"""SELECT * EXCLUDE (slot), {sql.SLOT_NAMES} AS description, CASE WHEN coalesced_points_25 IS NOT NULL THEN 1 END AS coalesced_weight_25,
  CASE WHEN coalesced_points_26 IS NOT NULL THEN 1 END AS coalesced_weight_26 FROM contributing""",
    sql.SLOTS,
)
def points_contributing(fx: Fixtures) -> DataFrame:
    return contributing(fx)


@query(
    "SELECT * FROM standings",
    sql.STANDINGS,
)
def ext_registrations(fx: Fixtures) -> DataFrame:
    return standings.season_standings(
        fx.point_series, fx.stand_in_penalties, fx.dim_results, fx.dim_races, fx.dim_registrations
    )


FITTED = BOTH + """, fitted_penalties AS (SELECT t.penalty_list_date, t.gender, t.athlete_id, a.standardized AS standardized_athlete_penalty_25,
    b.standardized AS standardized_athlete_penalty_26
  FROM (SELECT DISTINCT penalty_list_season, penalty_list_date, gender, athlete_id FROM base1) t
  LEFT JOIN v25done a USING (penalty_list_season, penalty_list_date, gender, athlete_id)
  LEFT JOIN v26done b USING (penalty_list_season, penalty_list_date, gender, athlete_id)), """


@query("SELECT * FROM standings", FITTED + sql.STANDINGS.replace("stand_in_penalties", "fitted_penalties"))
def standings_from_fitted_penalties(fx: Fixtures) -> DataFrame:
    """The whole way: windows, both fits, points, slots, standings."""
    races = windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    _, table = penalties.build_penalties(fx.dim_registrations, fx.dim_results, races)
    return standings.season_standings(fx.point_series, table, fx.dim_results, fx.dim_races, fx.dim_registrations)


def _renamed(text: str, **names: str) -> str:
    """SQL with other tables in the place of some."""
    for old, new in names.items():
        text = re.sub(rf"\b{old}\b", new, text)
    return text


FROM_FILES = (
    NEEDED
    + f""", file_races AS ({RACES_SQL}),
file_staged AS (SELECT n.race_id, n.gender, {STANDARD}, CAST(NULL AS VARCHAR) AS source_file_id, CAST(NULL AS VARCHAR) AS prep_results_url
  FROM season_sheets s JOIN needed n ON n.sheet_name = s.sheet_name), """
    + _renamed(DIM_RESULTS, staged="file_staged", dim_races="file_races")
    + f", file_results AS (SELECT {RESULT_COLUMNS.format(time='minutes')} FROM final)"
    + _renamed(REGISTERED.removeprefix(SPELLED), staged_registrations="season_forms")
    + """, file_penalties AS (SELECT * REPLACE (left(sha256(gender || ',Skier ' || substr(athlete_id, 2)), 12) AS athlete_id) FROM stand_in_penalties), """
    + _renamed(
        sql.STANDINGS, dim_results="file_results", dim_races="file_races", dim_registrations="registered", stand_in_penalties="file_penalties"
    )
)


def season_inputs(fx: Fixtures) -> season.Inputs:
    root = write_sheets(fx, "season_sheets")
    return season.Inputs(
        sheets=root,
        race_list=fx.race_list,
        inventory=sheets.file_inventory(fx.spark, root, folders=True),
        registrations=fx.season_forms.withColumnsRenamed(STAGED_REGISTRATION_NAMES),
        names=spelling_lookup(fx.name_spellings, "canonical", "variant", "line"),
        schools=spelling_lookup(fx.school_spellings, "canonical", "variant", "line"),
        non_people=fx.non_people,
        publications=fx.publications,
        contribution_windows=fx.contribution_windows,
        point_series=fx.point_series,
        athlete_penalties=fx.stand_in_penalties.withColumn(
            "athlete_id", short_hash(F.col("gender"), F.concat(F.lit("Skier "), F.substring("athlete_id", 2, 99)))
        ),
    )


@query("SELECT * FROM standings", FROM_FILES)
def files_to_standings(fx: Fixtures) -> DataFrame:
    """Result sheets and entry forms to standings, stage by stage."""
    return season.files_to_standings(season.StagedRun(fx.spark), season_inputs(fx))
