"""Which results count: the qualifier slot and the three best other races per technique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import OTHER_SLOTS, QUALIFIER_SERIES, QUALIFIER_SLOT, TECHNIQUES, VINTAGES

SLOT_KEY = ["registration_id", "technique"]
# what the slots read of the points table
READ = [
    "result_id",
    *SLOT_KEY,
    "athlete_name",
    "race_season",
    "race_name",
    "series",
    "is_registered_finish",
    *[f"{c}_{v}" for v in VINTAGES for c in ("race_penalty", "race_points")],
]


def points_results(results: DataFrame) -> DataFrame:
    """Registered finishes with points in either vintage."""
    scored = F.col("race_points_25").isNotNull() | F.col("race_points_26").isNotNull()
    rows = results.filter(F.col("is_registered_finish") & scored)
    return rows.withColumn("is_not_maq", F.col("series") != QUALIFIER_SERIES)


def contribution(vintage: str) -> Column:
    return F.struct(
        F.col("race_name"), F.col(f"race_points_{vintage}").alias("points"), F.col("series")
    )


def best_other_races(scored: DataFrame, vintage: str) -> DataFrame:
    """The best races outside the qualifier series, numbered from 1.

    Only as many as there are slots, which lets Spark drop the others before the shuffle.
    """
    points = f"race_points_{vintage}"
    order = Window.partitionBy(*SLOT_KEY).orderBy(points, "result_id")
    rows = scored.filter(F.col("is_not_maq") & F.col(points).isNotNull())
    return (
        rows.withColumn("rk", F.row_number().over(order))
        .filter(F.col("rk") <= len(OTHER_SLOTS))
        .select(*SLOT_KEY, "rk", contribution(vintage).alias("race"))
    )


def best_by_slot(scored: DataFrame) -> DataFrame:
    """One row per registration and technique: ``best_<vintage>_<slot>``, at most six races."""
    picks = [best_other_races(scored, v).withColumn("vintage", F.lit(v)) for v in VINTAGES]
    slots = range(1, len(OTHER_SLOTS) + 1)
    chosen = [
        F.max(F.when((F.col("vintage") == v) & (F.col("rk") == k), F.col("race"))).alias(f"best_{v}_{k}")
        for v in VINTAGES
        for k in slots
    ]
    return picks[0].unionByName(picks[1]).groupBy(*SLOT_KEY).agg(*chosen)


def qualifier_results(scored: DataFrame) -> DataFrame:
    """One qualifier result per registration, technique and vintage: best points, then result id."""
    rows = scored.filter((F.col("series") == QUALIFIER_SERIES) & F.col("technique").isin(TECHNIQUES))
    chosen = []
    for v in VINTAGES:
        points = F.col(f"race_points_{v}")
        order = F.struct(points.isNull(), points, F.col("result_id"))
        chosen.append(F.min_by(contribution(v), order).alias(f"maq_{v}"))
    return rows.groupBy(*SLOT_KEY).agg(*chosen)


def registration_techniques(registrations: DataFrame) -> DataFrame:
    """Every registration that is known not to be a ghost, with both techniques."""
    rows = registrations.filter(~F.col("is_ghost_registration"))
    rows = rows.select("registration_id", "athlete_name", "race_season").distinct()
    return rows.withColumn("technique", F.explode(F.array(*[F.lit(t) for t in TECHNIQUES])))


def scored_techniques(results: DataFrame) -> DataFrame:
    """Registration and technique of every result in a race with a penalty (ghosts included)."""
    penalty = F.col("race_penalty_25").isNotNull() | F.col("race_penalty_26").isNotNull()
    rows = results.filter(F.col("registration_id").isNotNull() & penalty)
    return rows.select("registration_id", "athlete_name", "race_season", "technique").distinct()


def slot_columns(vintage: str, race: Column) -> list[Column]:
    return [
        race["race_name"].alias(f"contributing_race_name_{vintage}"),
        race["points"].alias(f"contributing_race_points_{vintage}"),
        race["series"].alias(f"contributing_race_series_{vintage}"),
        F.col(f"maq_{vintage}")["points"].alias(f"maq_points_{vintage}"),
    ]


def qualifier_slots(registrations: DataFrame, qualifier: DataFrame) -> DataFrame:
    rows = registration_techniques(registrations).join(qualifier, SLOT_KEY, "left")
    columns = [c for v in VINTAGES for c in slot_columns(v, F.col(f"maq_{v}"))]
    return rows.select(
        "athlete_name",
        "race_season",
        *SLOT_KEY,
        F.lit(QUALIFIER_SLOT).alias("description"),
        F.lit(1).alias("weight"),
        *columns,
    )


def other_slots(results: DataFrame, qualifier: DataFrame, best: DataFrame) -> DataFrame:
    """Three slots each; a race only counts when it beats the qualifier points, if there are any."""
    rows = scored_techniques(results).join(qualifier, SLOT_KEY, "left").join(best, SLOT_KEY, "left")
    slots = []
    for k, description in enumerate(OTHER_SLOTS, start=1):
        races = []
        for v in VINTAGES:
            race, limit = F.col(f"best_{v}_{k}"), F.col(f"maq_{v}")["points"]
            races.append(F.when(limit.isNull() | (race["points"] < limit), race).alias(f"race_{v}"))
        slots.append(F.struct(F.lit(description).alias("description"), *races))
    rows = rows.withColumn("slot", F.explode(F.array(*slots)))
    columns = [c for v in VINTAGES for c in slot_columns(v, F.col("slot")[f"race_{v}"])]
    return rows.select(
        "athlete_name",
        "race_season",
        *SLOT_KEY,
        F.col("slot.description").alias("description"),
        F.lit(1).alias("weight"),
        *columns,
    )


def with_coalesced_points(slots: DataFrame) -> DataFrame:
    """Points of the slot's race, else the qualifier points; a weight only where there are points."""
    columns = ["athlete_name", "race_season", *SLOT_KEY, "description"]
    weights = []
    for v in VINTAGES:
        points = F.coalesce(f"contributing_race_points_{v}", f"maq_points_{v}")
        columns += [
            f"contributing_race_name_{v}",
            f"contributing_race_points_{v}",
            f"contributing_race_series_{v}",
            f"maq_points_{v}",
            F.col(f"maq_points_{v}").isNotNull().alias(f"is_maq_finisher_{v}"),
            points.alias(f"coalesced_points_{v}"),
        ]
        weights.append(F.when(points.isNotNull(), F.col("weight")).alias(f"coalesced_weight_{v}"))
    return slots.select(*columns, *weights)


def points_contributing_results(results: DataFrame, registrations: DataFrame) -> DataFrame:
    """One row per registration, technique and slot. ``results`` is read four times: pass a table."""
    scored = points_results(results)
    qualifier = qualifier_results(scored)
    slots = qualifier_slots(registrations, qualifier).unionByName(
        other_slots(results, qualifier, best_by_slot(scored))
    )
    return with_coalesced_points(slots)
