"""Fits against dense least squares, on both routes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seedline.operators import laplacian
from seedline.operators.components import components
from seedline.operators.least_squares import fit_race_effects, fit_winner_differences, solve_race_effects

KEYS = ["grp"]


def race_frame(seed, n_races=12, n_athletes=15, density=0.5, parts=1):
    rng = np.random.default_rng(seed)
    rows = []
    for part in range(parts):
        for r in range(n_races):
            for a in range(n_athletes):
                if rng.random() < density:
                    rows.append((f"g{seed}", f"r{part}_{r}", f"a{part}_{a}", rng.normal(3, 0.2)))
    return pd.DataFrame(rows, columns=["grp", "race_id", "athlete_id", "y"])


def dense_race_effects(pdf):
    r, races = pd.factorize(pdf.race_id)
    a, athletes = pd.factorize(pdf.athlete_id)
    x = np.zeros((len(pdf) + 1, len(races) + len(athletes)))
    x[np.arange(len(pdf)), r] = 1
    x[np.arange(len(pdf)), len(races) + a] = 1
    x[-1, len(races):] = 1
    coef = np.linalg.lstsq(x, np.append(pdf.y, 0.0), rcond=None)[0]
    return dict(zip([f"race:{k}" for k in races] + [f"athlete:{k}" for k in athletes], coef))


def dense_winner_effects(pdf):
    m = len(pdf)
    codes, names = pd.factorize(pd.concat([pdf.athlete_id, pdf.reference_athlete_id]))
    x = np.zeros((m + 1, len(names)))
    np.add.at(x, (np.arange(m), codes[:m]), 1)
    np.add.at(x, (np.arange(m), codes[m:]), -1)
    x[-1] = 1 / len(names)
    y = np.append(pdf.y, 0.0)
    coef = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    return dict(zip(names, coef))


@pytest.fixture(params=["in_task", "distributed", "mixed"])
def route(request, spark):
    limit = {"in_task": "1000000", "distributed": "1", "mixed": "120"}[request.param]
    spark.conf.set("seedline.rowsPerTask", limit)
    yield request.param
    spark.conf.unset("seedline.rowsPerTask")


def test_race_effects(spark, route):
    # one component, two components, a single athlete and race, uneven race sizes
    frames = [
        race_frame(1),
        race_frame(2, parts=2, n_races=9),
        pd.DataFrame([("g3", "r", "a", 3.1)], columns=["grp", "race_id", "athlete_id", "y"]),
        race_frame(4, n_races=6, n_athletes=40, density=0.2),
    ]
    pdf = pd.concat(frames)
    got = fit_race_effects(spark.createDataFrame(pdf), KEYS).toPandas()
    for frame in frames:
        grp = frame.grp.iloc[0]
        mine = got[got.grp == grp]
        mine = dict(zip(mine.kind + ":" + mine.node, mine.effect))
        want = dense_race_effects(frame)
        assert mine.keys() == want.keys()
        assert max(abs(mine[k] - want[k]) for k in want) < 1e-7


def chain(n):
    """Athlete i meets athlete i + 1 in race i; the fit is exact."""
    rng = np.random.default_rng(n)
    own, race = rng.normal(0, 0.1, n + 1), rng.normal(3, 0.1, n)
    rows = [("chain", f"r{i}", f"a{i + k}", race[i] + own[i + k]) for i in range(n) for k in (0, 1)]
    return pd.DataFrame(rows, columns=["grp", "race_id", "athlete_id", "y"]), own - own.mean()


@pytest.mark.parametrize("n,limit", [(1500, "1000000"), (1500, "1"), (12000, "1000000"), (12000, "1")])
def test_chains_on_both_routes(spark, n, limit):
    pdf, want = chain(n)
    spark.conf.set("seedline.rowsPerTask", limit)
    got = fit_race_effects(spark.createDataFrame(pdf), KEYS).where("kind = 'athlete'").toPandas()
    spark.conf.unset("seedline.rowsPerTask")
    effect = got.set_index("node").effect
    assert len(effect) == n + 1 and max(abs(effect[f"a{i}"] - want[i]) for i in range(n + 1)) < 1e-9


@pytest.mark.parametrize("limit", ["1000000", "1"])
def test_not_a_number_is_an_error_that_names_the_list(spark, limit):
    frame = race_frame(1)
    frame.loc[3, "y"] = float("inf")
    spark.conf.set("seedline.rowsPerTask", limit)
    try:
        with pytest.raises(Exception, match="list g1 has times that are not finite"):
            fit_race_effects(spark.createDataFrame(frame), KEYS).collect()
    finally:
        spark.conf.unset("seedline.rowsPerTask")


def test_a_list_that_does_not_converge_is_named(monkeypatch):
    monkeypatch.setattr(laplacian, "most_rounds", lambda unknowns: 2)
    with pytest.raises(RuntimeError, match="list x did not converge"):
        solve_race_effects(race_frame(1, n_races=30, n_athletes=40), "list x")


def test_links_are_not_shuffled_again(spark, tiny_tasks):
    """A round moves vectors only: nothing is exchanged between the written links and the join with the vector."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = spark.range(400).selectExpr("'g' AS grp", "concat('n', id % 20) AS node", "concat('m', id % 7) AS other", "1.0D AS w")
        both = links.unionByName(links.selectExpr("grp", "other AS node", "node AS other", "w"))
        table, sizes = laplacian.core_table(both, KEYS)
        sums = laplacian.neighbour_sums(table, sizes.withColumn("p", F.lit(1.0)), KEYS)
        assert {(r.node, r.s) for r in sums.collect()} == {(r.node, r.degree) for r in sizes.collect()}
        plan = sums._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        join = max(i for i, line in enumerate(lines[:scan]) if "Join" in line)
        assert not any("Exchange" in line for line in lines[join:scan])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_components_of_a_long_chain(spark):
    links = spark.range(10_000).selectExpr("'g' AS grp", "concat('n', lpad(id, 5, '0')) AS a", "concat('n', lpad(id + 1, 5, '0')) AS b")
    found, rounds = components(links.unionByName(spark.sql("SELECT 'g' AS grp, 'x' AS a, 'x' AS b")), KEYS)
    assert rounds < 20
    assert {(r.label, r.n) for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()} == {("n00000", 10_001), ("x", 1)}


def winner_rows(pdf):
    best = pdf.sort_values(["y", "athlete_id"]).groupby("race_id").first()
    pdf = pdf.join(best, on="race_id", rsuffix="_w")
    pdf = pdf[pdf.athlete_id != pdf.athlete_id_w]
    return pd.DataFrame(
        {
            "grp": pdf.grp,
            "athlete_id": pdf.athlete_id,
            "reference_athlete_id": pdf.athlete_id_w,
            "y": pdf.y - pdf.y_w,
        }
    ).reset_index(drop=True)


def test_winner_differences(spark, route):
    # several winners, disconnected parts, and one race only (a star: the level is not identified)
    frames = [
        winner_rows(race_frame(5)),
        winner_rows(race_frame(6, parts=2)),
        winner_rows(race_frame(7, n_races=1)),
    ]
    pdf = pd.concat(frames)
    got = fit_winner_differences(spark.createDataFrame(pdf), KEYS).toPandas()
    for frame in frames:
        mine = got[got.grp == frame.grp.iloc[0]]
        mine = dict(zip(mine.athlete_id, mine.effect))
        want = dense_winner_effects(frame)
        assert mine.keys() == want.keys()
        assert max(abs(mine[k] - want[k]) for k in want) < 1e-7


@pytest.mark.parametrize("square", [1 << 22, 60])
def test_large_lists_with_few_hubs_are_eliminated_slice_by_slice(spark, monkeypatch, square):
    """Above the limit of a task, with few races or winners, no round of the distributed solver runs and the answers are the same."""
    monkeypatch.setattr(laplacian, "SQUARE", square)
    monkeypatch.setattr(laplacian, "_eliminated", None)
    spark.conf.set("seedline.rowsPerTask", "100")
    try:
        frames = [race_frame(21, n_athletes=60), race_frame(22, parts=2, n_races=8, n_athletes=40, density=0.3), race_frame(23, n_races=5)]
        frames[0] = pd.concat([frames[0], frames[0].head(30).assign(y=lambda f: f.y + 0.1)])  # the same athlete and race twice
        got = fit_race_effects(spark.createDataFrame(pd.concat(frames)), KEYS).toPandas()
        for frame in frames:
            mine, want = got[got.grp == frame.grp.iloc[0]], dense_race_effects(frame)
            mine = dict(zip(mine.kind + ":" + mine.node, mine.effect))
            assert mine.keys() == want.keys() and max(abs(mine[k] - want[k]) for k in want) < 1e-7
        frames = [winner_rows(race_frame(24, n_athletes=60)), winner_rows(race_frame(25, parts=2, n_races=8, n_athletes=40)), winner_rows(race_frame(26, n_races=1, n_athletes=300))]
        got = fit_winner_differences(spark.createDataFrame(pd.concat(frames)), KEYS).toPandas()
        for frame in frames:
            mine, want = got[got.grp == frame.grp.iloc[0]], dense_winner_effects(frame)
            mine = dict(zip(mine.athlete_id, mine.effect))
            assert mine.keys() == want.keys() and max(abs(mine[k] - want[k]) for k in want) < 1e-7
    finally:
        spark.conf.unset("seedline.rowsPerTask")
