"""Points, slots and standings on a small hand-made season."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from seedline.operators import groups
from seedline.plans import points, slots, standings

DAY = date(2026, 1, 10)


@pytest.fixture(scope="module")
def season(spark):
    """Race r1 has eight finishers, r2 two penaltied ones, r3 three; q is the qualifier; n gives no points."""
    penalties = spark.createDataFrame(
        [(DAY, f"a{i}", 100.0 + 10 * i, 100.0 + 10 * i) for i in range(1, 8)] + [(date(2026, 6, 1), "a1", 1.0, 1.0)],
        "penalty_list_date date, athlete_id string, standardized_athlete_penalty_25 double, standardized_athlete_penalty_26 double",
    )
    times = {
        "r1": [20.0, 21.0, 22.0, 23.0, 24.0, 24.0, 25.0, None],
        "r2": [20.0, 21.0],
        "r3": [30.0, 31.0, 32.0],
        "q": [40.0, 41.0, 42.0],
        "n": [20.0, 21.0, 22.0],
        "early": [20.0, 21.0, 22.0],
    }
    rows = []
    for race, values in times.items():
        day = date(2026, 1, 9) if race == "early" else DAY  # the list of the same day already counts
        for i, t in enumerate(values, start=1):
            rows.append((f"{race}-{i}", race, f"a{i}", 2026, "b", f"A{i}", "", t, i, day))
    results = spark.createDataFrame(
        rows,
        "result_id string, race_id string, athlete_id string, race_season long, gender string, athlete_name string, "
        "time string, time_float double, finish_place long, race_date date",
    )
    races = spark.createDataFrame(
        [(r, DAY, 2026, f"Race {r}", {"q": "MAQ", "n": "NP"}.get(r, "S"), "CL", "DI" if r == "r3" else "RL", "", "", "") for r in times],
        "race_id string, race_date date, race_season long, race_name string, series string, technique string, discipline string, "
        "division string, venue string, race_format string",
    )
    registrations = spark.createDataFrame(
        [(f"g{i}", f"a{i}", f"A{i}", 2026, "b", i == 3, True, i == 1) for i in range(1, 8) if i != 4] + [("g9", "a9", "A9", 2026, "b", False, True, True)],
        "registration_id string, athlete_id string, athlete_name string, race_season long, gender string, is_ghost_registration boolean, "
        "is_ehs_eligible boolean, is_u16c_eligible boolean",
    )
    contributions = spark.createDataFrame(
        [("S", "true", 0.5, None), ("MAQ", "true", None, None), ("NP", "false", None, None)],
        "series string, is_point_generating string, compression_factor_di double, compression_factor_sp double",
    )
    return contributions, penalties, results, races, registrations


@pytest.fixture(scope="module", params=["plain", "spread"])
def table(request, spark, season):
    if request.param == "spread":
        spark.conf.set("seedline.rowsPerTask", "1")
    rows = points.ext_results(*season).cache()
    found = {r["result_id"]: r for r in rows.collect()}
    spark.conf.unset("seedline.rowsPerTask")
    return rows, found


def geomean(values):
    product = 1.0
    for v in values:
        product *= v
    return product ** (1 / len(values))


def test_podium_ties_and_minimum(table):
    _, found = table
    first = found["r1-1"]
    assert first["penaltied_athlete_count_25"] == 7
    assert [found[f"r1-{i}"]["penaltied_athlete_place_26"] for i in range(1, 9)] == [1, 2, 3, 4, 5, 5, 7, None]
    # places 1 to 5 hold six athletes because of the tie; the other vintage takes places 1 to 6
    assert first["race_penalty_25"] == round(geomean([110, 120, 130, 140, 150, 160]), 2)
    assert first["race_penalty_26"] == round(geomean([110, 120, 130, 140, 150, 160]), 2)
    assert abs(first["race_penalty_time_25"] - geomean([20, 21, 22, 23, 24, 24])) < 1e-9
    assert found["r2-1"]["race_penalty_25"] is None  # two are not enough
    assert found["r3-1"]["race_penalty_25"] == round(geomean([110, 120, 130]), 2)
    assert found["early-1"]["penalty_list_date"] is None and found["r1-1"]["penalty_list_date"] == DAY


def test_points_and_compression(table):
    _, found = table
    row = found["r3-2"]
    ratio = 31 / geomean([30, 31, 32])
    assert row["compression_factor_25"] == 1.0 and row["compression_factor_26"] == 0.5
    assert row["race_points_25"] == round(round(geomean([110, 120, 130]), 2) * ratio, 2)
    assert row["race_points_26"] == round(round(geomean([110, 120, 130]), 2) * ratio**0.5, 2)


def test_reasons(table):
    _, found = table
    reasons = {k: r["reason_for_no_points"] for k, r in found.items()}
    assert reasons["n-1"] == "Race is not scored for points"
    assert reasons["r1-8"] == "Racer has no finish time (e.g., DNS/DNF/DQ)"
    assert reasons["r1-4"] == reasons["r1-3"] == "Racer is not eligible for points"  # unregistered, ghost
    assert reasons["r2-1"] == "Race is unscorable"
    assert reasons["r1-1"] == ""
    assert found["r1-1"]["ma_points_2026_str"] == str(found["r1-1"]["race_points_26"])
    assert found["r1-3"]["ma_points_2026_str"] == ""


def test_season_ranks(table):
    _, found = table
    mine = [found[f"{r}-1"] for r in ("r1", "r2", "r3", "q", "n", "early")]
    scored = sorted(r["race_points_25"] for r in mine if r["race_points_25"] is not None)
    for r in mine:
        want = scored.index(r["race_points_25"]) + 1 if r["race_points_25"] is not None else len(scored) + 1
        assert r["race_rank_by_athlete_season_25"] == r["race_rank_per_technique_by_athlete_season_25"] == want
    assert found["r1-3"]["race_rank_by_athlete_season_25"] is None


def test_slots_and_standings(spark, season, table):
    rows, found = table
    registrations = season[-1]
    contributing = slots.points_contributing_results(rows, registrations).cache()
    mine = {
        (r["registration_id"], r["technique"], r["description"][:1]): r for r in contributing.collect()
    }
    # a1: the qualifier plus two better races at most; the empty slots take the qualifier points
    maq = found["q-1"]["race_points_25"]
    better = sorted(p for p in (found["r1-1"]["race_points_25"], found["r3-1"]["race_points_25"]) if p < maq)
    for k in range(3):
        row = mine[("g1", "CL", str(k + 2))]
        assert row["contributing_race_points_25"] == (better[k] if k < len(better) else None)
        assert row["coalesced_points_25"] == (better[k] if k < len(better) else maq)
        assert row["coalesced_weight_25"] == 1 and row["is_maq_finisher_25"]
    # without a qualifier result: only the races there are
    assert mine[("g5", "CL", "1")]["coalesced_points_25"] is None
    assert mine[("g5", "CL", "2")]["coalesced_points_25"] == found["r1-5"]["race_points_25"]
    assert mine[("g5", "CL", "3")]["coalesced_weight_25"] is None
    # a ghost has slots without points; a registration without races has the qualifier slot only
    assert mine[("g3", "CL", "2")]["coalesced_points_26"] is None and ("g3", "CL", "1") not in mine
    assert ("g9", "CL", "1") in mine and ("g9", "CL", "2") not in mine

    final = {r["registration_id"]: r for r in standings.ext_registrations(contributing, registrations).collect()}
    assert len(final) == registrations.count()
    points_ = [maq, *better] + [maq] * (3 - len(better))
    assert abs(final["g1"]["cl_points_25"] - sum(points_) / 4) < 0.0051
    assert final["g1"]["total_points_25"] is None  # no skating points
    assert final["g9"]["cl_points_25"] is None


def test_qualifying_places(spark):
    rows = spark.createDataFrame(
        [("a", 2026, "b", True, True, 10.0), ("b", 2026, "b", True, False, 10.0), ("c", 2026, "b", True, True, 12.0), ("d", 2026, "b", False, True, 1.0),
         ("e", 2026, "b", True, True, None), ("f", 2026, "g", True, None, 5.0)],
        "registration_id string, race_season long, gender string, is_ehs_eligible boolean, is_u16c_eligible boolean, total_points_25 double",
    ).withColumn("total_points_26", F.col("total_points_25"))
    for spread in (False, True):
        got = {r[0]: (r[1], r[2]) for r in standings.with_qualifying_places(rows, spread=spread)
               .select("registration_id", "ehsc_qualifying_place_25", "u16c_qualifying_place_26").collect()}
        assert got == {"a": (1, 2), "b": (1, None), "c": (3, 3), "d": (None, 1), "e": (None, None), "f": (1, None)}


def test_published_order(spark):
    from seedline.plans.outputs import sort_output

    rows = spark.createDataFrame([(2025, "g", "z"), (2026, "b", "y"), (2025, "b", "x"), (None, "b", "w"), (2025, "b", "a")],
                                 "race_season long, gender string, registration_id string")
    assert [r["registration_id"] for r in sort_output(rows, "ext_registrations").collect()] == ["a", "x", "z", "y", "w"]


def test_positions_over_slices(spark):
    import pytest

    from seedline.plans.outputs import with_positions

    # a third of the rows agree in season and gender; NULLs come last in every column
    rows = [(None if i % 50 == 0 else 2020 + i % 5 if i % 3 else 2020, None if i % 7 == 0 else "bg"[i % 2], f"r{i * 7919 % 5000:04d}", i) for i in range(5000)]
    table = spark.createDataFrame(rows, "race_season int, gender string, registration_id string, position_ int").repartition(7)

    def last(v):
        return (v is None, v or 0 if not isinstance(v, str) else v)

    want = sorted(rows, key=lambda r: (last(r[0]), (r[1] is None, r[1] or ""), r[2]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several slices also here
    try:
        got = with_positions(table, "ext_registrations")
        assert got.columns == [*table.columns, "position"]
        assert {r["registration_id"]: r["position"] for r in got.collect()} == {r[2]: n for n, r in enumerate(want, 1)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    empty = with_positions(table.limit(0), "ext_registrations")
    assert empty.collect() == [] and empty.columns == got.columns and empty.dtypes == got.dtypes
    with pytest.raises(ValueError, match="position"):
        with_positions(got, "ext_registrations")


def test_points_alone_need_no_window_over_the_results(season):
    """Places and season ranks that nobody reads are not computed, and no task is handed a race's rows for the points."""
    rows = points.ext_results(*season, columns=["result_id", "race_points_26"])
    assert rows.columns == ["result_id", "race_points_26"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "RepartitionByExpression" not in plan


def test_rows_of_ranks_are_dealt_by_their_number(spark, season, table, monkeypatch):
    """Tasks follow from the rows, whatever spark.sql.shuffle.partitions says; the ranks stay."""
    monkeypatch.setattr(groups, "DEALT_ROWS", 2)
    rows = points.ext_results(*season)
    assert rows.rdd.getNumPartitions() == -(-season[2].count() // 2)
    assert {r["result_id"]: r for r in rows.collect()} == table[1]
