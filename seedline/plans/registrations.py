"""Season registrations and the athlete table derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import EHS_GRADES, ELIGIBLE_CATEGORIES, GHOST_CATEGORY, U16_AGES
from ..functions.text import (
    club_name,
    full_name,
    gender_code,
    parse_grade,
    school_or_other,
    short_hash,
    strip,
    title_case,
    to_whole_number,
)
from ..operators.joins import replace_by_lookup

CATEGORY = "Category Entered / Merchandise Ordered"
REGISTRATION_COLUMNS = [
    "registration_id",
    "race_season",
    "athlete_id",
    "athlete_name",
    "gender",
    "is_ghost_registration",
    "school",
    "club",
    "city_town",
    "state",
    "nensa_number",
    "usss_number",
    "birth_year",
    "grade",
    "usss_age",
    "is_ehs_eligible",
    "is_u16c_eligible",
]
NOT_ON_ATHLETES = [
    "grade",
    "race_season",
    "registration_id",
    "usss_age",
    "is_ehs_eligible",
    "is_u16c_eligible",
]


def is_eligible_category(category: Column) -> Column:
    return F.coalesce(strip(category).isin(ELIGIBLE_CATEGORIES), F.lit(False))


def is_ghost_category(category: Column) -> Column:
    """Exact match, not trimmed."""
    return F.coalesce(category == GHOST_CATEGORY, F.lit(False))


def with_eligibility(registrations: DataFrame) -> DataFrame:
    """Age at the start of the season and the two eligibility flags."""
    age = F.col("race_season") - 1 - F.col("birth_year")
    return registrations.withColumn("usss_age", age.cast("bigint")).withColumns(
        {
            "is_ehs_eligible": F.coalesce(F.col("grade").isin(EHS_GRADES), F.lit(False)),
            "is_u16c_eligible": F.coalesce(F.col("usss_age").isin(U16_AGES), F.lit(False)),
        }
    )


def dim_registrations(staged: DataFrame, names: DataFrame, schools: DataFrame) -> DataFrame:
    """Eligible and ghost registrations in one pass over the staged rows."""

    def given(name: str) -> Column:
        return (F.col(f"`{name}`") if name in staged.columns else F.lit(None)).cast("string")

    ghost = is_ghost_category(given(CATEGORY))

    def unless_ghost(c: Column) -> Column:
        return F.when(~F.col("is_ghost_registration"), c)

    rows = staged.filter(is_eligible_category(given(CATEGORY)) | ghost)
    rows = rows.withColumn("is_ghost_registration", ghost).select(
        full_name(given("First Name"), given("Last Name")).alias("athlete_name"),
        to_whole_number(F.col("race_season")).alias("race_season"),
        title_case(given("City")).alias("city_town"),
        F.upper(given("State")).alias("state"),
        F.when(F.col("is_ghost_registration"), title_case(given("School")))
        .otherwise(school_or_other(given("School"), given("SchoolOth")))
        .alias("school"),
        club_name(given("Club")).alias("club"),
        gender_code(given("Gender")).alias("gender"),
        unless_ghost(to_whole_number(given("NENSA License"))).alias("nensa_number"),
        unless_ghost(to_whole_number(given("USSS Member #"))).alias("usss_number"),
        unless_ghost(to_whole_number(given("Birth Year"))).alias("birth_year"),
        unless_ghost(parse_grade(given("Grade"))).alias("grade"),
        "is_ghost_registration",
    )
    rows = replace_by_lookup(rows, "athlete_name", names)
    rows = replace_by_lookup(rows, "school", schools)
    rows = rows.withColumn("athlete_id", short_hash(F.col("gender"), F.col("athlete_name")))
    rows = rows.withColumn("registration_id", short_hash(F.col("athlete_id"), F.col("race_season")))
    rows = with_eligibility(rows)
    return rows.filter("is_ghost_registration OR is_ehs_eligible OR is_u16c_eligible").select(
        *REGISTRATION_COLUMNS
    )


def without_ghosts(registrations: DataFrame) -> DataFrame:
    """An unknown ghost flag counts as not a ghost."""
    return registrations.filter(~F.coalesce("is_ghost_registration", F.lit(False)))


def latest_known(registrations: DataFrame) -> DataFrame:
    """Per athlete and column: the value of the newest season that has one."""
    newest = F.struct("race_season", "registration_id")
    columns = [c for c in registrations.columns if c != "athlete_id"]
    return registrations.groupBy("athlete_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), newest)).alias(c) for c in columns]
    )


def registered_seasons(registrations: DataFrame) -> DataFrame:
    """One boolean column per season, newest first. The seasons are read once (a handful of years); a NULL season has no column."""
    known = registrations.select("race_season").distinct().dropna()
    seasons = sorted((r[0] for r in known.collect()), reverse=True)
    flags = (
        registrations.groupBy("athlete_id")
        .pivot("race_season", seasons)
        .agg(F.lit(True))
        .fillna(False)
    )
    return flags.withColumnsRenamed({str(s): f"was_registered_eligible_{s}" for s in seasons})


def dim_athletes(registrations: DataFrame) -> DataFrame:
    """Newest known data of each athlete and the seasons of registration."""
    rows = without_ghosts(registrations)
    # each part is back-filled by itself, so the grade may come from an older season
    graduation = (F.col("race_season") + 12 - F.col("grade")).cast("bigint")
    latest = latest_known(rows).withColumn("graduation_year", graduation).drop(*NOT_ON_ATHLETES)
    return latest.join(registered_seasons(rows), "athlete_id", "left")
