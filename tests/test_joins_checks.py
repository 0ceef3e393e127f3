from datetime import date

import pytest
from pyspark.sql import functions as F

from seedline.operators import checks, joins
from seedline.plans import windows


def test_lookup_last_line_wins_and_does_not_chain(spark):
    table = spark.createDataFrame([("B", "a", 1), ("C", "a", 2), ("D", "C", 3), (None, "z", 4)], "canonical string, variant string, line int")
    lookup = joins.spelling_lookup(table, "canonical", "variant", "line")
    rows = spark.createDataFrame([("a",), ("C",), ("q",), (None,), ("z",)], "name string")
    got = {r[0] for r in joins.replace_by_lookup(rows, "name", lookup).collect()}
    assert got == {"C", "D", "q", None}  # a -> C (not on to D), z -> NULL


def test_as_of_is_inclusive(spark):
    dates = spark.createDataFrame([(date(2026, 1, d),) for d in (1, 5, 9, 9)] + [(None,)], "race_date date")
    marks = spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 1, 8),), (date(2026, 1, 8),)], "m date")
    got = dict(joins.latest_on_or_before(dates, "race_date", marks, "m").collect())
    assert got == {date(2026, 1, 1): None, date(2026, 1, 5): date(2026, 1, 5), date(2026, 1, 9): date(2026, 1, 8)}


@pytest.fixture
def calendar(spark):
    publications = spark.createDataFrame([(date(2026, 3, 1), 2026), (date(2026, 3, 1), 2027)], "penalty_list_date date, penalty_list_season long")
    contributions = spark.createDataFrame(
        [("A", 4, False), ("B", 8, True), ("E", 3, None)],
        "series string, contributing_window_weeks int, current_season_supplants_previous_season boolean",
    )
    races = spark.createDataFrame(
        [
            ("on_list_date", "A", date(2026, 3, 1), 2026),
            ("on_start", "A", date(2026, 2, 1), 2026),
            ("before_start", "A", date(2026, 1, 31), 2026),
            ("old_season", "B", date(2026, 1, 10), 2025),
            ("new_season", "B", date(2026, 1, 20), 2026),
            ("no_window", "Z", date(2026, 2, 10), 2026),
            ("no_date", "A", None, 2026),
            ("late", "A", date(2026, 7, 1), 2026),
        ],
        "race_id string, series string, race_date date, race_season long",
    )
    return publications, contributions, races


def test_window_boundaries(calendar):
    rows = windows.races_by_penalty_window(*calendar).select("penalty_list_season", "race_id").collect()
    assert sorted(map(tuple, rows)) == [(s, r) for s in (2026, 2027) for r in ("new_season", "on_start")]


def test_window_warnings(calendar):
    with pytest.warns(UserWarning) as seen:
        windows.races_by_penalty_window(*calendar)
    texts = " ".join(str(w.message) for w in seen)
    assert "['Z']" in texts and "1 race(s)" in texts


def test_empty_windows(spark, calendar):
    publications, contributions, races = calendar
    assert windows.races_by_penalty_window(publications.limit(0), contributions, races).count() == 0


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [r[0] for r in checks.not_one_row(df, ["k"]).collect()] == ["a"]
    assert [r[0] for r in checks.several_values(df, ["k"], "v").collect()] == ["a"]
    with pytest.raises(checks.CheckFailed, match="twice"):
        checks.require_none(checks.not_one_row(df, ["k"]), "twice")
    checks.require_none(checks.not_one_row(df.filter(F.col("k") == "b"), ["k"]), "fine")
