"""Model fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..plans import penalties
from ..plans.windows import races_by_penalty_window
from ..session import durable
from . import sql
from .joining import RESIDUALS, residual_rows, stand_in
from .registry import query, rounded, rounded_sql
from .scalars import _model_base

GROUP = "penalty_list_season, penalty_list_date, gender"
ROUNDS = 25


def alternating_means(base: str, tag: str, rounds: int = ROUNDS) -> str:
    """The race-and-athlete fit as unrolled alternating means; every list here is connected."""
    steps = [
        f"""{tag}r0 AS MATERIALIZED (SELECT {GROUP}, race_id, avg(log_time) AS v FROM {base} GROUP BY ALL),
{tag}a0 AS MATERIALIZED (SELECT {GROUP}, athlete_id, avg(log_time - v) AS v FROM {base} JOIN {tag}r0 USING ({GROUP}, race_id) GROUP BY ALL)"""
    ]
    for i in range(1, rounds):
        steps.append(
            f"""{tag}r{i} AS MATERIALIZED (SELECT {GROUP}, race_id, avg(log_time - v) AS v FROM {base}
  JOIN {tag}a{i - 1} USING ({GROUP}, athlete_id) GROUP BY ALL),
{tag}a{i} AS MATERIALIZED (SELECT {GROUP}, athlete_id, avg(log_time - v) AS v FROM {base}
  JOIN {tag}r{i} USING ({GROUP}, race_id) GROUP BY ALL)"""
        )
    last = rounds - 1
    steps.append(
        f"""{tag}mid AS (SELECT {GROUP}, avg(v) AS m FROM {tag}a{last} GROUP BY ALL),
{tag}athlete AS (SELECT {GROUP}, athlete_id, v - m AS effect FROM {tag}a{last} JOIN {tag}mid USING ({GROUP})),
{tag}race AS (SELECT {GROUP}, race_id, v + m AS effect FROM {tag}r{last} JOIN {tag}mid USING ({GROUP}))"""
    )
    return ",\n".join(steps)


FIRST_FIT = (
    sql.MODEL_ROWS
    + ", base1 AS MATERIALIZED (SELECT penalty_list_season, penalty_list_date, gender, race_id, athlete_id, log_time FROM model_rows), "
    + alternating_means("base1", "p")
)
WITH_OUTLIERS = (
    FIRST_FIT
    + f""", res1 AS MATERIALIZED (SELECT b.*, b.log_time - r.effect - a.effect AS initial_residual FROM base1 b
    JOIN prace r USING ({GROUP}, race_id) JOIN pathlete a USING ({GROUP}, athlete_id)),
out1 AS MATERIALIZED (SELECT *, coalesce(count(*) OVER w >= 5 AND stddev_samp(initial_residual) OVER w > 0 AND initial_residual >
      avg(initial_residual) OVER w + 2 * stddev_samp(initial_residual) OVER w, false) AS is_outlier_race
  FROM res1 WINDOW w AS (PARTITION BY {GROUP}, athlete_id))"""
)
SECOND_FIT = (
    WITH_OUTLIERS + ", base2 AS MATERIALIZED (SELECT * FROM out1 WHERE NOT is_outlier_race), " + alternating_means("base2", "q")
)


def window_results(fx: Fixtures) -> DataFrame:
    rows = penalties.with_log_features(penalties.with_winner(_model_base(fx)))
    return durable(rows.select(*penalties.WINDOW_COLUMNS), "window-results")


@query(
    f"""SELECT {GROUP}, 'athlete' AS kind, athlete_id AS node, {rounded_sql('effect', 'effect', 5)} FROM pathlete
UNION ALL SELECT {GROUP}, 'race', race_id, {rounded_sql('effect', 'effect', 5)} FROM prace""",
    FIRST_FIT,
)
def fit_2026(fx: Fixtures) -> DataFrame:
    effects = penalties.fit_2026(window_results(fx))
    return effects.select(*penalties.LIST, "kind", "node", rounded("effect", 5))


def unrolled_gradients(rounds: int = 45) -> str:
    """The winner-difference fit in SQL: conjugate gradients from zero, every list at once."""
    steps = [
        f"""pairs AS MATERIALIZED (SELECT {GROUP}, athlete_id AS i, reference_athlete_id AS j, count(*) AS w, sum(time_log_ratio) AS y
  FROM model_rows WHERE athlete_id <> reference_athlete_id GROUP BY ALL),
links AS MATERIALIZED (SELECT {GROUP}, i AS src, j AS dst, 1 AS sgn, w, y FROM pairs
  UNION ALL SELECT {GROUP}, j, i, -1, w, y FROM pairs),
sizes AS (SELECT {GROUP}, sum(w) + 1 AS n_rows, sum(y) AS sum_y FROM pairs GROUP BY ALL),
ends AS (SELECT {GROUP}, src AS node, sum(w) AS degree, sum(sgn * w) AS net, sum(sgn * y) AS pull FROM links GROUP BY ALL),
centred AS (SELECT *, count(*) OVER g AS n, (net + 1.0::DOUBLE / count(*) OVER g) / n_rows AS u FROM ends JOIN sizes USING ({GROUP})
  WINDOW g AS (PARTITION BY {GROUP})),
s0 AS MATERIALIZED (SELECT {GROUP}, node, degree, n, n_rows, u, 0.0::DOUBLE AS x, pull - u * sum_y AS r, pull - u * sum_y AS p FROM centred)"""
    ]
    window = f"WINDOW g AS (PARTITION BY {GROUP})"
    for k in range(rounds):
        steps.append(
            f"""q{k} AS (SELECT s.*, degree * p - coalesce(b.near, 0) + sum(p) OVER g / (n * n) - n_rows * u * sum(u * p) OVER g AS q
  FROM s{k} s LEFT JOIN (SELECT {GROUP}, dst AS node, sum(w * p) AS near FROM links JOIN (SELECT {GROUP}, node AS src, p FROM s{k}) v
    USING ({GROUP}, src) GROUP BY ALL) b USING ({GROUP}, node) {window}),
a{k} AS (SELECT *, sum(r * r) OVER g AS rr, CASE WHEN sum(r * r) OVER g > 1e-26 THEN sum(r * r) OVER g / sum(p * q) OVER g ELSE 0 END AS step
  FROM q{k} {window}),
t{k} AS (SELECT {GROUP}, node, degree, n, n_rows, u, p, rr, step, x + step * p AS x, r - step * q AS r FROM a{k}),
s{k + 1} AS MATERIALIZED (SELECT {GROUP}, node, degree, n, n_rows, u, x, r,
    r + CASE WHEN step > 0 THEN sum(r * r) OVER g / rr ELSE 0 END * p AS p FROM t{k} {window})"""
        )
    steps.append(f"winner_fit AS (SELECT {GROUP}, node AS athlete_id, x AS effect FROM s{rounds})")
    return ",\n".join(steps)


WINNER_FIT = sql.MODEL_ROWS + ", " + unrolled_gradients()


@query(f"SELECT {GROUP}, athlete_id, {rounded_sql('effect', 'effect', 5)} FROM winner_fit", WINNER_FIT)
def fit_2025(fx: Fixtures) -> DataFrame:
    effects = penalties.fit_2025(window_results(fx))
    return effects.select(*penalties.LIST, "athlete_id", rounded("effect", 5))


@query(
    "SELECT penalty_list_season, penalty_list_date, gender, race_id, athlete_id, coalesce(is_outlier_race, false) AS is_outlier_race FROM flagged_races",
    RESIDUALS,
)
def outlier_flag(fx: Fixtures) -> DataFrame:
    return penalties.with_outlier_flag(residual_rows(fx)).select(*penalties.DIAGNOSTIC_KEY, "is_outlier_race")


@query(f"SELECT {GROUP}, athlete_id, {rounded_sql('effect', 'effect', 5)} FROM qathlete", SECOND_FIT)
def refit_without_outliers(fx: Fixtures) -> DataFrame:
    athletes, _ = penalties.fit_2026_twice(window_results(fx))
    return athletes.select(*penalties.LIST, "athlete_id", rounded("effect", 5))


@query(
    f"""SELECT {GROUP}, race_id, athlete_id, is_outlier_race, {rounded_sql('initial_residual', 'initial_residual', 5)},
  {rounded_sql('o.log_time - r.effect - a.effect', 'adjusted_residual', 5)} FROM out1 o
LEFT JOIN qrace r USING ({GROUP}, race_id) LEFT JOIN qathlete a USING ({GROUP}, athlete_id)""",
    SECOND_FIT,
)
def adjusted_residual(fx: Fixtures) -> DataFrame:
    rows = window_results(fx)
    diagnosed, _ = penalties.penalties_2026(rows)
    residuals = [rounded(f"{c}_residual", 5) for c in ("initial", "adjusted")]
    return diagnosed.select(*penalties.DIAGNOSTIC_KEY, "is_outlier_race", *residuals)


SCALED = """stand AS (SELECT q.penalty_list_season, s.* FROM stand_in_penalties s JOIN publications q ON q.penalty_list_date = s.penalty_list_date),
means AS (SELECT penalty_list_season, penalty_list_date, gender, avg(p) AS m FROM (SELECT *, standardized_athlete_penalty_26 AS p,
    quantile_cont(standardized_athlete_penalty_26, 0.25) OVER w AS lo, quantile_cont(standardized_athlete_penalty_26, 0.75) OVER w AS hi
  FROM stand WINDOW w AS (PARTITION BY penalty_list_season, penalty_list_date, gender)) t WHERE p BETWEEN lo AND hi GROUP BY ALL)"""


@query(
    f"SELECT {GROUP}, athlete_id, {rounded_sql('standardized_athlete_penalty_26 * 200 / m', 'penalty', 6)} FROM stand JOIN means USING ({GROUP})",
    SCALED,
)
def scale_to_target(fx: Fixtures) -> DataFrame:
    rows = stand_in(fx).withColumn("penalty", F.col("standardized_athlete_penalty_26"))
    return penalties.scale_to_target(rows, "penalty").select(*penalties.LIST, "athlete_id", rounded("penalty"))


COHORT = """stand AS (SELECT q.penalty_list_season, s.penalty_list_date, s.gender, s.athlete_id, s.standardized_athlete_penalty_26 AS p
  FROM stand_in_penalties s JOIN publications q ON q.penalty_list_date = s.penalty_list_date),
cohort AS (SELECT s.penalty_list_season, s.gender, s.athlete_id FROM stand s JOIN (SELECT penalty_list_season, gender, min(penalty_list_date) AS d
    FROM stand GROUP BY ALL) f ON f.penalty_list_season = s.penalty_list_season AND f.gender = s.gender AND f.d = s.penalty_list_date),
means AS (SELECT penalty_list_season, penalty_list_date, gender, avg(p) AS m FROM (SELECT stand.*, quantile_cont(p, 0.25) OVER w AS lo,
    quantile_cont(p, 0.75) OVER w AS hi FROM stand JOIN cohort USING (penalty_list_season, gender, athlete_id)
  WINDOW w AS (PARTITION BY penalty_list_season, penalty_list_date, gender)) t WHERE p BETWEEN lo AND hi GROUP BY ALL)"""


@query(f"SELECT {GROUP}, athlete_id, {rounded_sql('p * 200 / m', 'standardized', 6)} FROM stand LEFT JOIN means USING ({GROUP})", COHORT)
def standardize_cohort(fx: Fixtures) -> DataFrame:
    rows = stand_in(fx).withColumnRenamed("standardized_athlete_penalty_26", "penalty")
    rows = penalties.standardize_cohort(rows, "penalty", "standardized")
    return rows.select(*penalties.LIST, "athlete_id", rounded("standardized"))


def finished_sql(effects: str, tag: str) -> str:
    """Scaling to the target and standardising by the first-date cohort: ``<tag>done`` with p and standardized."""
    middle = f"""SELECT {GROUP}, avg(p) AS m FROM (SELECT @t.*, quantile_cont(p, 0.25) OVER w AS lo, quantile_cont(p, 0.75) OVER w AS hi
    FROM @t WINDOW w AS (PARTITION BY {GROUP})) z WHERE p BETWEEN lo AND hi GROUP BY ALL"""
    return f"""{tag}raw AS MATERIALIZED (SELECT {GROUP}, athlete_id, exp(effect) AS p FROM {effects}),
{tag}mid AS ({middle.replace('@t', f'{tag}raw')}),
{tag}scaled AS MATERIALIZED (SELECT {GROUP}, athlete_id, p * 200 / m AS p FROM {tag}raw JOIN {tag}mid USING ({GROUP})),
{tag}first AS (SELECT penalty_list_season, gender, min(penalty_list_date) AS d FROM {tag}scaled GROUP BY ALL),
{tag}cohort AS (SELECT x.* FROM {tag}scaled x WHERE EXISTS (SELECT 1 FROM {tag}first f JOIN {tag}scaled o ON o.penalty_list_season = f.penalty_list_season
    AND o.gender = f.gender AND o.penalty_list_date = f.d
  WHERE o.penalty_list_season = x.penalty_list_season AND o.gender = x.gender AND o.athlete_id = x.athlete_id)),
{tag}level AS ({middle.replace('@t', f'{tag}cohort')}),
{tag}done AS (SELECT {GROUP}, athlete_id, p, p * 200 / m AS standardized FROM {tag}scaled LEFT JOIN {tag}level USING ({GROUP}))"""


BOTH = f"{SECOND_FIT}, {unrolled_gradients()}, {finished_sql('winner_fit', 'v25')}, {finished_sql('qathlete', 'v26')}"
PENALTY_COLUMNS = [f"{prefix}athlete_penalty_{v}" for v in sql.VINTAGES for prefix in ("", "standardized_")]


@query(
    f"""SELECT t.penalty_list_season, t.penalty_list_date, t.gender, t.athlete_id, g.athlete_name, g.school, g.club, g.city_town, g.state,
  g.usss_age, g.grade, g.is_ehs_eligible, g.is_u16c_eligible, {rounded_sql('a.p', 'athlete_penalty_25', 3)},
  {rounded_sql('a.standardized', 'standardized_athlete_penalty_25', 3)}, {rounded_sql('b.p', 'athlete_penalty_26', 3)},
  {rounded_sql('b.standardized', 'standardized_athlete_penalty_26', 3)}
FROM (SELECT DISTINCT {GROUP}, athlete_id FROM base1) t LEFT JOIN v25done a USING ({GROUP}, athlete_id)
LEFT JOIN v26done b USING ({GROUP}, athlete_id)
LEFT JOIN dim_registrations g ON g.race_season = t.penalty_list_season AND g.athlete_id = t.athlete_id""",
    BOTH,
)
def build_penalties(fx: Fixtures) -> DataFrame:
    races = races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    _, table = penalties.build_penalties(fx.dim_registrations, fx.dim_results, races)
    return table.withColumns({c: rounded(c, 3) for c in PENALTY_COLUMNS})
