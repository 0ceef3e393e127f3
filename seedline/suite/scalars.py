"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..functions import numbers, text
from ..operators.joins import flag_members
from ..fixed_values import GRADE_NUMBERS, GRADE_WORDS, UNIDENTIFIED_ATHLETE
from ..plans import penalties, points, slots, standings
from ..session import durable
from . import sql
from .registry import query, rounded, rounded_sql

CLEAN_SQL = r"""trim(replace(regexp_replace(trim(replace(name_raw, chr(160), ' '), chr(32) || chr(9)), ' +', ' ', 'g'), '*', ''))"""
TITLE_SQL = r"""array_to_string(list_transform(regexp_extract_all(@s, '\p{L}+|[^\p{L}]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"""


def title_sql(expr: str) -> str:
    return TITLE_SQL.replace("@s", expr)


@query(f"SELECT c_custkey, {CLEAN_SQL} AS clean_name FROM raw_names")
def fn_clean_name(fx: Fixtures) -> DataFrame:
    return fx.raw_names.select("c_custkey", text.clean_name(F.col("name_raw")).alias("clean_name"))


@query(f"SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN name_raw ELSE {title_sql('name_raw')} END AS name FROM raw_names")
def fn_title_case(fx: Fixtures) -> DataFrame:
    untouched = F.col("c_mktsegment") == "BUILDING"
    name = F.when(untouched, F.col("name_raw")).otherwise(text.title_case(F.col("name_raw")))
    return fx.raw_names.select("c_custkey", name.alias("name"))


TIME_SQL = r"""CASE WHEN NOT regexp_full_match(trim(replace(time_raw, '''', '')), '([0-9.]+:){0,2}[0-9.]+') THEN NULL ELSE
  list_sum(list_transform(list_reverse(string_split(trim(replace(time_raw, '''', '')), ':')),
    lambda x, i: CAST(x AS DOUBLE) * CASE i WHEN 1 THEN 1.0::DOUBLE / 60 WHEN 2 THEN 1 ELSE 60 END)) END"""


@query(
    f"SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, time_raw, {rounded_sql(TIME_SQL, 'minutes', 9)} FROM raw_times"
)
def fn_time_to_min(fx: Fixtures) -> DataFrame:
    rows = fx.raw_times.withColumn("minutes", numbers.minutes_from_text(F.col("time_raw")))
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "time_raw", rounded("minutes", 9))


@query(
    r"""SELECT result_id, CASE WHEN time_float IS NULL THEN '' ELSE printf('%02d:%05.2f', CAST(floor(time_float) AS BIGINT),
  (time_float - floor(time_float)) * 60) END AS time_text FROM dim_results"""
)
def fn_min_to_str(fx: Fixtures) -> DataFrame:
    return fx.dim_results.select("result_id", numbers.minutes_to_text(F.col("time_float")).alias("time_text"))


@query(
    """SELECT result_id, left(sha256(gender || ',' || athlete_name), 12) AS athlete_hash,
  left(sha256(athlete_id || ',' || race_id), 12) AS result_hash,
  left(sha256(athlete_id || ',' || CAST(race_season AS VARCHAR)), 12) AS registration_hash FROM dim_results"""
)
def fn_hash_id(fx: Fixtures) -> DataFrame:
    def pair(a: str, b: str, name: str):
        return text.short_hash(F.col(a), F.col(b)).alias(name)

    return fx.dim_results.select(
        "result_id",
        pair("gender", "athlete_name", "athlete_hash"),
        pair("athlete_id", "race_id", "result_hash"),
        pair("athlete_id", "race_season", "registration_hash"),
    )


NAMED_SQL = f"""named AS (SELECT s.*, {title_sql(CLEAN_SQL)} AS athlete_name FROM staged s)"""


@query(
    """SELECT race_id, usss_id, n.athlete_name IN (SELECT non_person FROM non_people) AS is_unidentified_athlete,
  CASE WHEN n.athlete_name IN (SELECT non_person FROM non_people) THEN 'Unidentified Athlete' ELSE n.athlete_name END AS athlete_name
FROM named n""",
    NAMED_SQL,
)
def fn_unidentified(fx: Fixtures) -> DataFrame:
    name = text.title_case(text.clean_name(F.col("name_raw")))
    rows = fx.staged.select("race_id", "usss_id", name.alias("athlete_name"))
    rows = flag_members(rows, "athlete_name", fx.non_people, "non_person", "is_unidentified_athlete")
    name = F.when(F.col("is_unidentified_athlete"), F.lit(UNIDENTIFIED_ATHLETE)).otherwise(F.col("athlete_name"))
    return rows.select("race_id", "usss_id", "is_unidentified_athlete", name.alias("athlete_name"))


COMPACT_GRADE = "regexp_replace(lower(grade), '[^a-z0-9]', '', 'g')"
GRADE_BRANCHES = [f"WHEN contains(grade, '{number}') THEN {number}" for number in GRADE_NUMBERS]
GRADE_BRANCHES += [f"WHEN contains({COMPACT_GRADE}, '{word}') THEN {number}" for word, number in GRADE_WORDS.items()]
GRADE_SQL = f"CAST(CASE {' '.join(GRADE_BRANCHES)} END AS BIGINT)"


@query(f"SELECT last_name, grade, {GRADE_SQL} AS grade_number FROM staged_registrations")
def fn_parse_grade(fx: Fixtures) -> DataFrame:
    return fx.staged_registrations.select("last_name", "grade", text.parse_grade(F.col("grade")).alias("grade_number"))


SCHOOL_SQL = title_sql("(CASE WHEN school = 'Other' THEN school_oth ELSE school END)")


@query(f"SELECT last_name, {SCHOOL_SQL} AS school_name FROM staged_registrations")
def fn_school_or_other(fx: Fixtures) -> DataFrame:
    name = text.school_or_other(F.col("school"), F.col("school_oth"))
    return fx.staged_registrations.select("last_name", name.alias("school_name"))


FULL_NAME_SQL = title_sql("concat_ws(' ', first_name, last_name)")


@query(f"SELECT last_name, race_season, {FULL_NAME_SQL} AS athlete_name FROM staged_registrations")
def fn_full_name(fx: Fixtures) -> DataFrame:
    name = text.full_name(F.col("first_name"), F.col("last_name"))
    return fx.staged_registrations.select("last_name", "race_season", name.alias("athlete_name"))


@query(
    """SELECT last_name, TRY_CAST(nensa AS BIGINT) AS nensa_number, TRY_CAST(usss AS BIGINT) AS usss_number,
  TRY_CAST(birth_year AS BIGINT) AS birth_year FROM staged_registrations"""
)
def fn_numeric_coerce(fx: Fixtures) -> DataFrame:
    return fx.staged_registrations.select(
        "last_name",
        text.to_whole_number(F.col("nensa")).alias("nensa_number"),
        text.to_whole_number(F.col("usss")).alias("usss_number"),
        text.to_whole_number(F.col("birth_year")).alias("birth_year"),
    )


@query(
    """SELECT last_name, upper(state) AS state, CASE lower(gender) WHEN 'm' THEN 'b' WHEN 'f' THEN 'g' ELSE lower(gender) END AS gender
FROM staged_registrations"""
)
def fn_upper_lower(fx: Fixtures) -> DataFrame:
    return fx.staged_registrations.select(
        "last_name", F.upper("state").alias("state"), text.gender_code(F.col("gender")).alias("gender")
    )


@query(
    f"""SELECT penalty_list_season, penalty_list_date, race_id, athlete_id, {rounded_sql('log_time', 'log_time', 9)},
  {rounded_sql('time_log_ratio', 'time_log_ratio', 9)}, days_from_race_to_publication FROM model_rows""",
    sql.MODEL_ROWS,
)
def fn_log_features(fx: Fixtures) -> DataFrame:
    rows = penalties.with_log_features(penalties.with_winner(_model_base(fx)))
    return rows.select(
        "penalty_list_season",
        "penalty_list_date",
        "race_id",
        "athlete_id",
        rounded("log_time", 9),
        rounded("time_log_ratio", 9),
        "days_from_race_to_publication",
    )


def _model_base(fx: Fixtures) -> DataFrame:
    from ..plans.windows import races_by_penalty_window

    races = races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    return penalties.registered_window_results(fx.dim_registrations, fx.dim_results, races)


def scored(fx: Fixtures, *columns: str) -> DataFrame:
    """The points table, or the ``columns`` of it that are read."""
    return points.ext_results(
        fx.point_series, fx.stand_in_penalties, fx.dim_results, fx.dim_races, fx.dim_registrations, columns
    )


def scored_table(fx: Fixtures) -> DataFrame:
    """The points as a written table, with the columns that are read more than once."""
    return durable(scored(fx, *slots.READ), "ext-results")


def contributing(fx: Fixtures) -> DataFrame:
    return slots.points_contributing_results(scored_table(fx), fx.dim_registrations)


@query(
    "SELECT result_id, "
    + sql.per_vintage(f"{rounded_sql('ma_time_penalty_ratio_@v', 'ma_time_penalty_ratio_@v', 9)}")
    + " FROM timed",
    sql.POINTS.rsplit(", scored AS", 1)[0],
)
def fn_time_ratio(fx: Fixtures) -> DataFrame:
    ratios = [f"ma_time_penalty_ratio_{v}" for v in sql.VINTAGES]
    return scored(fx, "result_id", *ratios).select("result_id", *[rounded(c, 9) for c in ratios])


@query("SELECT result_id, race_points_25, race_points_26 FROM scored", sql.POINTS)
def fn_race_points(fx: Fixtures) -> DataFrame:
    return scored(fx, "result_id", "race_points_25", "race_points_26")


@query(
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, round(l_extendedprice / 7 * 100) / 100 AS rounded FROM raw_times"
)
def fn_round2(fx: Fixtures) -> DataFrame:
    value = numbers.round2(F.col("l_extendedprice") / 7)
    return fx.raw_times.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", value.alias("rounded")
    )


@query(
    "SELECT registration_id, sk_points_25, cl_points_25, total_points_25, sk_points_26, cl_points_26, total_points_26 FROM totals",
    sql.STANDINGS,
)
def fn_total_points(fx: Fixtures) -> DataFrame:
    table = standings.season_standings(
        fx.point_series, fx.stand_in_penalties, fx.dim_results, fx.dim_races, fx.dim_registrations
    )
    return table.select(
        "registration_id", *[f"{c}_points_{v}" for v in sql.VINTAGES for c in ("sk", "cl", "total")]
    )


@query(
    f"""SELECT registration_id, technique, {sql.SLOT_NAMES} AS description, coalesced_points_25, coalesced_points_26,
  CASE WHEN coalesced_points_25 IS NOT NULL THEN 1 END AS coalesced_weight_25,
  CASE WHEN coalesced_points_26 IS NOT NULL THEN 1 END AS coalesced_weight_26 FROM contributing""",
    sql.SLOTS,
)
def fn_coalesced_points(fx: Fixtures) -> DataFrame:
    table = contributing(fx)
    kinds = [f"{c}_{v}" for c in ("coalesced_points", "coalesced_weight") for v in sql.VINTAGES]
    return table.select("registration_id", "technique", "description", *kinds)


