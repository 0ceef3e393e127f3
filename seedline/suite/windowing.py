"""Window functions, sorts, limits, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..operators.groups import is_hot, with_row_number
from ..plans import penalties, points, results, slots, standings, windows
from ..plans import outputs
from . import sql
from .joining import placed, stand_in
from .registry import query
from .scalars import _model_base, contributing, scored, scored_table


@query(
    """SELECT result_id, race_id, gender, CASE WHEN time_float IS NOT NULL THEN
  (SELECT count(*) FROM dim_results o WHERE o.race_id = r.race_id AND o.gender = r.gender AND o.time_float < r.time_float) + 1 END AS finish_place
FROM dim_results r"""
)
def win_finish_place(fx: Fixtures) -> DataFrame:
    rows = fx.dim_results.drop("finish_place")
    return results.with_finish_place(rows).select("result_id", "race_id", "gender", "finish_place")


@query("SELECT result_id, penaltied_athlete_place_25, penaltied_athlete_place_26 FROM placed", sql.PLACED)
def win_penaltied_place(fx: Fixtures) -> DataFrame:
    return placed(fx).select("result_id", "penaltied_athlete_place_25", "penaltied_athlete_place_26")


@query(f"SELECT result_id, {sql.SEASON_RANKS} FROM scored", sql.POINTS)
def win_season_rank(fx: Fixtures) -> DataFrame:
    ranks = [f"race_rank_{kind}athlete_season_{v}" for v in sql.VINTAGES for kind in ("by_", "per_technique_by_")]
    return scored(fx, "result_id", *ranks)


@query("SELECT registration_id, technique, race_name, points, rk FROM best_26", sql.SLOTS)
def win_best_non_maq(fx: Fixtures) -> DataFrame:
    rows = slots.points_results(scored_table(fx)).filter("is_not_maq AND race_points_26 IS NOT NULL")
    rows = rows.select("registration_id", "technique", "race_name", "result_id", F.col("race_points_26").alias("points"))
    spread = is_hot(rows, slots.SLOT_KEY)
    ranked = with_row_number(rows, slots.SLOT_KEY, ["points", "result_id"], "rk", spread=spread)
    return ranked.select("registration_id", "technique", "race_name", "points", "rk")


PLACES = [f"{p}_{v}" for v in sql.VINTAGES for p in ("ehsc_qualifying_place", "u16c_qualifying_place")]


@query(f"SELECT registration_id, {', '.join(PLACES)} FROM standings", sql.STANDINGS)
def win_qualifying_place(fx: Fixtures) -> DataFrame:
    table = standings.season_standings(
        fx.point_series, fx.stand_in_penalties, fx.dim_results, fx.dim_races, fx.dim_registrations
    )
    return table.select("registration_id", *PLACES)


@query(
    """SELECT penalty_list_season, penalty_list_date, race_id, gender, athlete_id,
  rank() OVER (PARTITION BY penalty_list_date, race_id, gender ORDER BY time_float) AS ma_athlete_place FROM model_rows""",
    sql.MODEL_ROWS,
)
def win_athlete_place(fx: Fixtures) -> DataFrame:
    rows = penalties.with_athlete_place(_model_base(fx))
    return rows.select("penalty_list_season", "penalty_list_date", "race_id", "gender", "athlete_id", "ma_athlete_place")


@query("SELECT penalty_list_date, race_id, gender, min(reference_athlete_id) AS reference_athlete_id FROM model_rows GROUP BY ALL", sql.MODEL_ROWS)
def win_reference_winner(fx: Fixtures) -> DataFrame:
    rows = penalties.with_winner(_model_base(fx))
    return rows.select("penalty_list_date", "race_id", "gender", "reference_athlete_id").distinct()


@query(
    """SELECT DISTINCT penalty_list_season, gender, athlete_id FROM (SELECT q.penalty_list_season, s.gender, s.athlete_id, s.penalty_list_date,
    min(s.penalty_list_date) OVER (PARTITION BY q.penalty_list_season, s.gender) AS first_date
  FROM stand_in_penalties s JOIN publications q ON q.penalty_list_date = s.penalty_list_date) t WHERE penalty_list_date = first_date"""
)
def win_first_date_cohort(fx: Fixtures) -> DataFrame:
    return penalties.first_date_cohort(stand_in(fx))


@query(
    """SELECT penalty_list_season, penalty_list_date, series, race_id, race_date, race_season FROM window_races
ORDER BY penalty_list_season DESC, penalty_list_date, series, race_date""",
    sql.WINDOWS,
)
def sort_output(fx: Fixtures) -> DataFrame:
    table = windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    return outputs.sort_output(table, "ext_races_by_penalty_window")


@query(
    """SELECT penalty_list_season, penalty_list_date, series, race_id, race_date, race_season,
  row_number() OVER (ORDER BY penalty_list_season DESC NULLS LAST, penalty_list_date NULLS LAST, series NULLS LAST, race_date NULLS LAST,
    race_id NULLS LAST) AS position
FROM window_races""",
    sql.WINDOWS,
)
def sort_output_positions(fx: Fixtures) -> DataFrame:
    table = windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    return outputs.with_positions(table, "ext_races_by_penalty_window")


@query(
    """SELECT race_season, gender, registration_id,
  row_number() OVER (ORDER BY race_season NULLS LAST, gender NULLS LAST, registration_id NULLS LAST) AS position FROM dim_registrations"""
)
def sort_output_registrations(fx: Fixtures) -> DataFrame:
    return outputs.with_positions(fx.dim_registrations.select("race_season", "gender", "registration_id"), "ext_registrations")


@query(
    "SELECT result_id, penaltied_athlete_place_26 AS place FROM placed WHERE penaltied_athlete_count_26 >= 3 AND penaltied_athlete_place_26 <= 6",
    sql.PLACED,
)
def top_k_per_group(fx: Fixtures) -> DataFrame:
    podium = placed(fx).filter(points.on_podium("26"))
    return podium.select("result_id", F.col("penaltied_athlete_place_26").alias("place"))


@query(
    """SELECT race_id, gender, athlete_id AS winner, time_float FROM dim_results WHERE time_float IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY race_id, gender ORDER BY time_float, athlete_id) = 1"""
)
def top_1_per_group(fx: Fixtures) -> DataFrame:
    timed = fx.dim_results.filter("time_float IS NOT NULL")
    best = timed.groupBy("race_id", "gender").agg(F.min(F.struct("time_float", "athlete_id")).alias("_w"))
    return best.select("race_id", "gender", F.col("_w.athlete_id").alias("winner"), F.col("_w.time_float").alias("time_float"))


@query(f"SELECT registration_id, technique, {sql.SLOT_NAMES} AS description FROM slots", sql.SLOTS.rsplit(", contributing AS", 1)[0])
def union_all_by_name(fx: Fixtures) -> DataFrame:
    return contributing(fx).select("registration_id", "technique", "description")
