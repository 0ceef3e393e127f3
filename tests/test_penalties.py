"""Penalty tables: outliers, scaling, and the same answer on both routes."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedline.fixtures import Fixtures
from seedline.plans import penalties, windows

D1, D2 = date(2026, 1, 1), date(2026, 2, 1)


def test_outlier_needs_enough_races(spark):
    residuals = [0.0, 0.01, -0.01, 0.0, 0.02, -0.02, 0.0, 0.01, -0.01, 0.5]
    rows = [("many", i, r) for i, r in enumerate(residuals)] + [("few", i, r) for i, r in enumerate([0.0, 0.0, 0.0, 9.0])]
    rows += [("fast", i, -r) for i, r in enumerate(residuals)] + [("flat", i, 0.25) for i in range(8)]
    df = spark.createDataFrame([(2026, D1, "b", a, f"r{i}", r) for a, i, r in rows],
                               "penalty_list_season long, penalty_list_date date, gender string, athlete_id string, race_id string, initial_residual double")
    for spread in (False, True):
        flagged = penalties.with_outlier_flag(df, spread=spread).filter("is_outlier_race").select("athlete_id", "race_id").collect()
        assert [tuple(r) for r in flagged] == [("many", "r9")]
    # exactly five races: 2 sigma cannot be exceeded by one of five, so a smaller sigma shows the count is inclusive
    five = df.filter("athlete_id = 'many' AND race_id IN ('r0', 'r1', 'r2', 'r3', 'r9')")
    assert penalties.with_outlier_flag(five, sigma=1.5).filter("is_outlier_race").count() == 1
    assert penalties.with_outlier_flag(five, sigma=1.5, min_races=6).filter("is_outlier_race").count() == 0


def test_scaling(spark):
    values = [("b", D1, "a", 1.0), ("b", D1, "c", 2.0), ("b", D1, "d", 4.0), ("b", D2, "a", 3.0), ("b", D2, "c", 5.0), ("b", D2, "new", 50.0), ("g", D2, "z", None)]
    df = spark.createDataFrame([(2026, g_d, g, a, v) for g, g_d, a, v in values], "penalty_list_season long, penalty_list_date date, gender string, athlete_id string, p double")
    scaled = {(r["gender"], r["penalty_list_date"], r["athlete_id"]): r["p"] for r in penalties.scale_to_target(df, "p").collect()}
    assert scaled[("b", D1, "c")] == 200.0 and scaled[("g", D2, "z")] is None  # the middle half is {2}
    out = {(r["penalty_list_date"], r["athlete_id"]): r["s"] for r in penalties.standardize_cohort(df, "p", "s").collect()}
    # second date: the cohort is {a, c}; both quartiles lie inside, nobody is in the middle half
    assert out[(D1, "c")] == 200.0 and out[(D2, "new")] is None


def dense_penalties(rows):
    """Both methods by dense least squares, one list at a time: {(date, gender, athlete): (p25, p26)} before standardising."""

    def scaled(effects):
        raw = np.exp(np.array(list(effects.values())))
        lo, hi = np.quantile(raw, [0.25, 0.75])
        return dict(zip(effects, raw * 200 / raw[(raw >= lo) & (raw <= hi)].mean()))

    def race_fit(g):
        races, athletes = sorted(set(g.race_id)), sorted(set(g.athlete_id))
        x = np.zeros((len(g) + 1, len(races) + len(athletes)))
        for i, (r, a) in enumerate(zip(g.race_id, g.athlete_id)):
            x[i, races.index(r)] = x[i, len(races) + athletes.index(a)] = 1
        x[-1, len(races):] = 1
        coef = np.linalg.lstsq(x, np.append(g.log_time, 0), rcond=None)[0]
        return x[:-1] @ coef, dict(zip(athletes, coef[len(races):]))

    found = {}
    for (day, gender), g in rows.groupby(["penalty_list_date", "gender"]):
        g = g.reset_index(drop=True)
        fitted, _ = race_fit(g)
        g["resid"] = g.log_time - fitted
        stats = g.groupby("athlete_id").resid.agg(["mean", "std", "size"]).loc[g.athlete_id].reset_index(drop=True)
        outlier = (stats["size"] >= 5) & (stats["std"] > 0) & (g.resid > stats["mean"] + 2 * stats["std"])
        p26 = scaled(race_fit(g[~outlier].reset_index(drop=True))[1])
        b = g[g.athlete_id != g.reference_athlete_id]
        names = sorted(set(b.athlete_id) | set(b.reference_athlete_id))
        x = np.zeros((len(b) + 1, len(names)))
        for i, (a, w) in enumerate(zip(b.athlete_id, b.reference_athlete_id)):
            x[i, names.index(a)], x[i, names.index(w)] = 1, -1
        x[-1] = 1 / len(names)
        y = np.append(b.time_log_ratio, 0)
        coef = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
        p25 = scaled(dict(zip(names, coef)))
        for a in set(g.athlete_id):
            found[(day, gender, a)] = (p25.get(a), p26.get(a))
    return found


@pytest.fixture(scope="module")
def inputs(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    races = windows.races_by_penalty_window(fx.publications, fx.contribution_windows, fx.dim_races)
    races = races.filter("penalty_list_season IN (2021, 2022)")
    return fx.dim_registrations, fx.dim_results, races


@pytest.mark.parametrize("limit", ["1000000", "1"])
def test_build_penalties(spark, inputs, limit):
    spark.conf.set("seedline.rowsPerTask", limit)
    try:
        rows, table = penalties.build_penalties(*inputs)
        rows, table = rows.toPandas(), table.toPandas()
    finally:
        spark.conf.unset("seedline.rowsPerTask")
    want = dense_penalties(rows)
    assert len(table) == len(want) and len(table) > 20
    for _, r in table.iterrows():
        p25, p26 = want[(r.penalty_list_date, r.gender, r.athlete_id)]
        assert (p25 is None and np.isnan(r.athlete_penalty_25)) or abs(r.athlete_penalty_25 - p25) < 1e-5
        assert abs(r.athlete_penalty_26 - p26) < 1e-5
    assert rows.initial_residual.notna().all()


def test_winner_ties_and_duplicates(spark):
    rows = spark.createDataFrame(
        [(D1, "r", "b", "z", 10.0), (D1, "r", "b", "a", 10.0), (D1, "r", "b", "m", 12.0), (D2, "r", "b", "m", 12.0)],
        "penalty_list_date date, race_id string, gender string, athlete_id string, time_float double",
    )
    got = penalties.with_winner(rows).select("penalty_list_date", "reference_athlete_id").distinct().collect()
    assert {tuple(r) for r in got} == {(D1, "a"), (D2, "m")}


def test_diagnostics_of_repeated_rows(spark):
    key = (2026, D1, "b", "r", "a")
    rows = spark.createDataFrame([(*key, False, None, 0.2), (*key, True, 0.1, None)],
                                 "penalty_list_season long, penalty_list_date date, gender string, race_id string, athlete_id string, "
                                 "is_outlier_race boolean, initial_residual double, adjusted_residual double")
    got = penalties.diagnostics_by_key(rows).first()
    assert (got["is_outlier_race"], got["initial_residual"], got["adjusted_residual"]) == (True, 0.1, 0.2)
    bare = rows.select("penalty_list_season", "penalty_list_date", "gender", "race_id", "athlete_id").distinct()
    other = bare.withColumn("athlete_id", F.lit("b"))
    joined = penalties.with_diagnostics(bare.unionByName(other), penalties.diagnostics_by_key(rows))
    assert {r["athlete_id"]: r["is_outlier_race"] for r in joined.collect()} == {"a": True, "b": False}
