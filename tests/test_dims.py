from datetime import date

from seedline.operators.joins import spelling_lookup
from seedline.plans import registrations, results

NO_LOOKUP = "canonical string, variant string, line int"


def lookup(spark, *pairs):
    rows = [(c, v, i) for i, (c, v) in enumerate(pairs)]
    return spelling_lookup(spark.createDataFrame(rows, NO_LOOKUP), "canonical", "variant", "line")


def test_dim_results(spark):
    columns = "name_raw string, time_raw string, usss_id string, fis_id string, school_raw string, team_raw string, state_raw string, race_id string, gender string, source_file_id string"
    raw = [
        ("ann  o'lee *", "10:00", "r1", "b"),
        ("bo", "10:00", "r1", "b"),
        ("cy", "11:00", "r1", "b"),
        ("dee", "DNF", "r1", "b"),
        ("mcEc", "9:00", "ec", "b"),
        ("fore runner", "8:00", "ec", "b"),
        ("eve", "9:00", "unknown", "g"),
        ("flo", "9:00", None, "g"),
    ]
    staged = spark.createDataFrame([(n, t, "1", None, "my school", "t", "VT", r, g, "f") for n, t, r, g in raw], columns)
    races = spark.createDataFrame(
        [("r1", date(2026, 1, 1), 2026, "S"), ("ec", date(2026, 1, 2), 2026, "EC")], "race_id string, race_date date, race_season long, series string"
    )
    non_people = spark.createDataFrame([("fore runner",)], "non_person string")
    table = results.dim_results(staged, races, lookup(spark, ("Robert", "Bo")), lookup(spark, ("Academy", "My School")), non_people)
    assert table.columns[:10] == results.LEADING
    rows = {r["athlete_name"]: r for r in table.collect()}
    assert set(rows) == {"Ann O'Lee", "Robert", "Cy", "Dee", "mcEc", "Unidentified Athlete", "Eve", "Flo"}
    assert [rows[n]["finish_place"] for n in ("Ann O'Lee", "Robert", "Cy", "Dee", "Eve", "Flo")] == [1, 1, 3, None, 1, None]
    assert rows["Dee"]["time"] == "" and rows["Cy"]["time"] == "11:00.00"
    assert rows["Unidentified Athlete"]["is_unidentified_athlete"] and not rows["Cy"]["is_unidentified_athlete"]
    assert rows["Cy"]["school"] == "Academy" and rows["Eve"]["race_date"] is None
    assert len({r["result_id"] for r in rows.values()}) == len(rows)


def test_dim_registrations(spark):
    rows = [
        ("U16/EHS Qualifer - Boys ", "ann", "o'lee", "old town", "vt", "Other", "my school", "", "M", "12", "NO LICENSE", "2010", "10th", "2026"),
        ("GHOST", "bo", "lee", None, None, "Other", "x", "Ford", "f", "12", "13", "2010", "10", "2026"),
        (" GHOST", "no", "body", None, None, None, None, None, "f", None, None, None, "10", "2026"),
        ("U16/EHS Qualifer - Boys", "too", "old", None, None, None, None, None, "m", None, None, "1990", None, "2026"),
        ("U16/EHS Qualifer - Boys", "by", "age", None, None, None, None, None, "m", None, None, "2011", "", "2026"),
    ]
    columns = [registrations.CATEGORY, "First Name", "Last Name", "City", "State", "School", "SchoolOth", "Club", "Gender", "NENSA License", "USSS Member #", "Birth Year", "Grade", "race_season"]
    staged = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    empty = lookup(spark, ("x", "y"))
    got = {r["athlete_name"]: r for r in registrations.dim_registrations(staged, empty, empty).collect()}
    assert set(got) == {"Ann O'Lee", "Bo Lee", "By Age"}
    ann, bo, by = got["Ann O'Lee"], got["Bo Lee"], got["By Age"]
    assert (ann["gender"], ann["school"], ann["club"], ann["city_town"], ann["state"]) == ("b", "My School", None, "Old Town", "VT")
    assert (ann["nensa_number"], ann["usss_number"], ann["grade"], ann["usss_age"]) == (12, None, 10, 15)
    assert bo["is_ghost_registration"] and bo["grade"] is None and bo["nensa_number"] is None and bo["school"] == "Other"
    assert not by["is_ehs_eligible"] and by["is_u16c_eligible"]
    # a sheet without some of the columns still loads
    assert registrations.dim_registrations(staged.drop("City", "Club", "SchoolOth"), empty, empty).count() == 3


def test_dim_athletes(spark):
    columns = ", ".join(
        f"{c} {'long' if c in ('race_season', 'nensa_number', 'usss_number', 'birth_year', 'grade', 'usss_age') else 'boolean' if c.startswith('is_') else 'string'}"
        for c in registrations.REGISTRATION_COLUMNS
    )

    def row(i, season, ghost, school, grade):
        return (f"g{i}", season, "a", "Ann", "b", ghost, school, None, None, None, None, None, 2010, grade, None, True, False)

    table = spark.createDataFrame(
        [row(1, 2024, False, "Old", 9), row(2, 2025, False, "New", None), row(3, 2026, None, None, None), row(4, 2023, True, "Ghost", 8)], columns
    )
    got = registrations.dim_athletes(table).first()
    assert got["school"] == "New"
    assert got["graduation_year"] == 2026 + 12 - 9  # season and grade are the newest known, each by itself
    flags = [c for c in got.asDict() if c.startswith("was_registered_eligible_")]
    assert flags == [f"was_registered_eligible_{s}" for s in (2026, 2025, 2024)] and all(got[c] for c in flags)
