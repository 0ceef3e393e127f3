"""Season standings from the contributing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import OTHER_SLOTS, QUALIFIER_SLOT, TECHNIQUES, VINTAGES
from ..functions.numbers import compensated_sum, round2
from ..operators.groups import is_hot, with_rank
from ..session import durable
from .points import ext_results
from .slots import READ, points_contributing_results

PLACES = {"ehsc_qualifying_place": "is_ehs_eligible", "u16c_qualifying_place": "is_u16c_eligible"}


def technique_points(slots: DataFrame) -> DataFrame:
    """Weighted mean per registration and technique.

    The slots become columns first, which gives the sum a fixed order on any cluster.
    """
    names = [QUALIFIER_SLOT, *OTHER_SLOTS]
    stats = []
    for v in VINTAGES:
        points, weight = F.col(f"coalesced_points_{v}"), F.col(f"coalesced_weight_{v}")
        stats += [F.bool_or(f"is_maq_finisher_{v}").alias(f"is_maq_finisher_{v}")]
        stats += [F.nullif(F.sum(weight), F.lit(0)).alias(f"_weight_{v}")]
        for k, name in enumerate(names):
            in_slot = F.col("description") == name
            stats.append(F.sum(F.when(in_slot, points * weight)).alias(f"_slot_{v}_{k}"))
    rows = slots.groupBy("registration_id", "technique").agg(*stats)
    columns = ["registration_id", "technique"]
    for v in VINTAGES:
        total = compensated_sum([F.col(f"_slot_{v}_{k}") for k in range(len(names))])
        columns.append(f"is_maq_finisher_{v}")
        columns.append((total / F.col(f"_weight_{v}")).alias(f"technique_points_{v}"))
    return rows.select(*columns)


def by_technique(slots: DataFrame) -> DataFrame:
    """One row per registration, the techniques side by side (one shuffle, one join instead of two)."""
    columns = [F.first(f"{c}_{v}").alias(f"{c}_{v}") for c in ("is_maq_finisher", "technique_points") for v in VINTAGES]
    wide = technique_points(slots).groupBy("registration_id").pivot("technique", TECHNIQUES).agg(*columns)
    renamed = [F.col("registration_id")]
    for technique in TECHNIQUES:
        t = technique.lower()
        for v in VINTAGES:
            renamed.append(F.col(f"{technique}_is_maq_finisher_{v}").alias(f"is_maq_{t}_finisher_{v}"))
            renamed.append(round2(F.col(f"{technique}_technique_points_{v}")).alias(f"{t}_points_{v}"))
    return wide.select(*renamed)


def with_qualifying_places(standings: DataFrame, *, spread: bool | None = None) -> DataFrame:
    """Rank of the total among the eligible of the season and gender."""
    if spread is None:
        spread = is_hot(standings, ["race_season", "gender"])
    for place, flag in PLACES.items():
        for v in VINTAGES:
            name = f"{place}_{v}"
            keys = ["race_season", "gender", flag]
            standings = with_rank(standings, keys, f"total_points_{v}", name, spread=spread)
            standings = standings.withColumn(name, F.when(F.col(flag), F.col(name)))
    return standings


def ext_registrations(slots: DataFrame, registrations: DataFrame) -> DataFrame:
    """Registrations with technique points, totals and qualifying places."""
    spread = is_hot(registrations, ["race_season", "gender"])
    rows = registrations.join(by_technique(slots), "registration_id", "left")
    totals = {f"total_points_{v}": F.col(f"sk_points_{v}") + F.col(f"cl_points_{v}") for v in VINTAGES}
    rows = rows.withColumns(totals)
    if spread:
        rows = durable(rows, "standings")
    rows = with_qualifying_places(rows, spread=spread)
    flags = [f"is_maq_{t}_finisher_{v}" for v in VINTAGES for t in ("sk", "cl")]
    points = [f"{c}_points_{v}" for v in VINTAGES for c in ("sk", "cl", "total")]
    places = [f"{place}_{v}" for v in VINTAGES for place in PLACES]
    return rows.select(*registrations.columns, *flags, *points, *places)


def season_standings(
    contributions: DataFrame,
    penalties: DataFrame,
    results: DataFrame,
    races: DataFrame,
    registrations: DataFrame,
) -> DataFrame:
    """From results and penalties to the standings.

    What the slots read of the points table is written once in between, as it is read four times after that.
    """
    scored = durable(ext_results(contributions, penalties, results, races, registrations, READ), "ext-results")
    return ext_registrations(points_contributing_results(scored, registrations), registrations)
