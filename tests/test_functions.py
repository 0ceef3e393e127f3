import math

from pyspark.sql import functions as F

from seedline.functions import numbers, text


def apply(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_name(spark):
    got = apply(spark, text.clean_name, ["  Ann  Lee ", "Bo\t", "*Cy  Dee *", "", None, "A * B"])
    assert got == ["Ann Lee", "Bo", "Cy Dee", "", None, "A  B"]


def test_title_case_matches_python(spark):
    words = ["O'brien-SMITH", "mcDONALD 3rd", "ÉMILE zola", "", "a1b2", "jean-luc o'neil"]
    assert apply(spark, text.title_case, words) == [w.title() for w in words]
    assert apply(spark, text.title_case, [None]) == [None]


def test_times(spark):
    values = ["21:34.5", "1:02:03", "95", "'10:00", " 10:00 ", "DNF", "", None, "1:2:3:4", "1d", "NaN", "inf", "5:xx"]
    got = apply(spark, numbers.minutes_from_text, values)
    want = [21 + 34.5 / 60, 62 + 3 / 60, 95 / 60, 10.0, 10.0] + [None] * 8
    assert [g if g is None else round(g, 9) for g in got] == [w if w is None else round(w, 9) for w in want]


def test_time_text_rounds_like_python(spark):
    values = [21.575, 0.0, 125.0, 35.96666, 9.9999, 1 + 0.125 / 60, None, 46.635 / 60, 3.7772166, 59.9999999]

    def python(t):
        return "" if t is None else f"{int(t):02}:{(t - int(t)) * 60:05.2f}"

    assert apply(spark, numbers.minutes_to_text, values, "double") == [python(t) for t in values]


def test_grades(spark):
    values = ["10th", "Freshman", "first-year", "12", "2027", "", None, "SOPHOMORE", "junior", "Senior!", "none"]
    assert apply(spark, text.parse_grade, values) == [10, 9, 9, 12, 7, None, None, 10, 11, 12, None]


def test_small_lookups(spark):
    assert apply(spark, text.gender_code, ["M", "f", "b", "x", None]) == ["b", "g", "b", "x", None]
    clubs = ["My Team / Club is not listed.", "", "Eastern Mass Nordic, inc (EMXC)", "Ford", None]
    assert apply(spark, text.club_name, clubs) == [None, None, "EMXC", "Ford", None]
    numbers_ = ["12", "12.0", "1.5", "NO LICENSE", "", None, "1d", " 7 ", "12345678901234567"]
    want = [12, 12, None, None, None, None, None, 7, 12345678901234567]
    assert apply(spark, text.to_whole_number, numbers_) == want


def test_full_name_and_school(spark):
    df = spark.createDataFrame(
        [("ann", "o'lee", "Other", "my school"), (None, "lee", None, "x"), ("ann", None, "big school", None)],
        "f string, l string, s string, o string",
    )
    rows = df.select(text.full_name(F.col("f"), F.col("l")), text.school_or_other(F.col("s"), F.col("o"))).collect()
    assert [tuple(r) for r in rows] == [("Ann O'Lee", "My School"), ("Lee", None), ("Ann", "Big School")]


def test_hash(spark):
    from hashlib import sha256

    df = spark.createDataFrame([("b", "Ann"), (None, "Ann")], "g string, n string")
    got = [r[0] for r in df.select(text.short_hash(F.col("g"), F.col("n"))).collect()]
    assert got == [sha256(b"b,Ann").hexdigest()[:12], sha256(b",Ann").hexdigest()[:12]]


def test_round2_uses_the_binary_value(spark):
    assert apply(spark, numbers.round2, [1.005, 0.285, 2.675, None], "double") == [1.0, 0.28, 2.68, None]


def test_compensated_sum(spark):
    df = spark.createDataFrame([(1891.11, 545.08, 601.1, 1241.93), (1.0, None, None, 2.5)], "a double, b double, c double, d double")
    columns = [F.col(c) for c in "abcd"]
    got = [r[0] for r in df.select(numbers.compensated_sum(columns)).collect()]
    assert math.isclose(got[0], 4279.22) and got[1] == 3.5
    empty = df.select(numbers.compensated_sum([F.lit(None).cast("double")])).first()[0]
    assert empty is None
