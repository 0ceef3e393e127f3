import csv
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedline.operators.checks import CheckFailed
from seedline.plans import staging
from seedline.sources import prep, sheets
from seedline.sources.warehouse import TableNames, Warehouse


def write_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        csv.writer(f, quoting=csv.QUOTE_ALL).writerows(rows)


@pytest.fixture
def book(tmp_path):
    root = tmp_path / "book"
    write_csv(root / "prep_results_one.csv", [["Name", "Race Time", "Member #", "School", "Name"], ["Ann", "10:00", "7", "A, \"B\"", "x"], ["Bo", "", "", "", ""]])
    write_csv(root / "prep_results_two.csv", [["Elapsed", "x, y", "Skier Name"], ["DNF", "q", "Cy"]])
    write_csv(root / "other.csv", [["Name"], ["Nobody"]])
    write_csv(root / "deep" / "prep_results_three.csv", [["Skier Name", "Name"], ["second", "first"]])
    return str(root)


def test_mixed_headers_in_one_read(spark, book):
    rows = sheets.read_sheets(spark, book, folders=False).orderBy("sheet_name", "name_raw")
    got = {(r["sheet_name"], r["name_raw"]): r for r in rows.collect()}
    ann = got[("prep_results_one", "Ann")]
    assert (ann["time_raw"], ann["usss_id"], ann["school_raw"], ann["fis_id"]) == ("10:00", "7", 'A, "B"', None)
    assert got[("prep_results_one", "Bo")]["time_raw"] is None
    assert got[("prep_results_two", "Cy")]["time_raw"] == "DNF"
    assert rows.count() == 4  # the nested file is not part of this folder


def test_first_candidate_header_wins(spark, book):
    got = sheets.read_sheets(spark, book + "/deep", folders=False).first()
    assert got["name_raw"] == "first"


def test_no_sheets(spark, tmp_path):
    write_csv(tmp_path / "empty" / "a.csv", [])
    rows = sheets.read_sheets(spark, str(tmp_path / "empty"), folders=False)
    assert rows.count() == 0 and "time_raw" in rows.columns
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert sheets.union_sheets([], schema).schema == schema


def test_inventory(spark, book):
    flat = sheets.file_inventory(spark, book)
    assert sorted(r[0] for r in flat.select("sheet_name").collect()) == ["prep_results_one", "prep_results_two"]
    deep = sheets.infra_result_files(sheets.file_inventory(spark, book, recursive=True))
    assert deep.columns == ["race_id", "file_id", "modified_at", "source_type"] and deep.count() == 3
    assert sheets.file_inventory(spark, book, prefix="nothing").count() == 0


RACE_COLUMNS = (
    "race_id string, date string, name string, series string, technique string, discipline string, format string, "
    "division string, venue string, state string, race_season long, boys_results_name string"
)


def race_list(spark, titles):
    rows = [(f"r{i}", "2026-01-05", "n", "S", "CL", "DI", "f", "d", "v", "VT", 2026, t) for i, t in enumerate(titles)]
    return spark.createDataFrame(rows, RACE_COLUMNS)


def test_staging(spark, book, tmp_path):
    # sheets as folders: one part file each
    root = tmp_path / "folders"
    write_csv(root / "prep_results_one" / "part.csv", [["Name", "Race Time"], ["Ann", "10:00"]])
    write_csv(root / "prep_results_spare" / "part.csv", [["Name"], ["Unwanted"]])
    inventory = sheets.file_inventory(spark, str(root), folders=True)
    with pytest.warns(UserWarning) as seen:
        staged, races = staging.staged_results(str(root), race_list(spark, [" prep_results_one ", "prep_results_missing", " "]), inventory)
    texts = sorted(str(w.message) for w in seen)
    assert "1 missing sheet(s)" in texts[0] and "('r1', 'b', 'prep_results_missing')" in texts[0]
    assert "1 orphaned sheet(s)" in texts[1] and "prep_results_spare" in texts[1]
    rows = staged.collect()
    assert [(r["name_raw"], r["race_id"], r["gender"]) for r in rows] == [("Ann", "r0", "b")]
    assert rows[0]["created_at"] is not None
    urls = {r["race_id"]: r["prep_results_url_b"] for r in races.collect()}
    assert urls["r0"].startswith("https://") and urls["r1"] is None and urls["r2"] is None
    by_file = staging.staged_results_by_file(str(root), sheets.infra_result_files(inventory))
    assert {(r["race_id"], r["name_raw"]) for r in by_file.collect()} == {("prep_results_one", "Ann"), ("prep_results_spare", "Unwanted")}
    store = sheets.SheetStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        with pytest.warns(UserWarning):
            kept, _ = staging.staged_results(str(root), race_list(spark, [" prep_results_one ", "prep_results_missing", " "]), inventory, store)
        assert [(r["name_raw"], r["race_id"], r["gender"]) for r in kept.collect()] == [("Ann", "r0", "b")]
        assert store.seen().count() == 1  # the spare sheet is not opened, the other one once


def test_sheet_report_of_empty_lists(spark):
    inventory = spark.createDataFrame([("prep_results_a", "f1", None), ("notes", "f2", None)], "sheet_name string, source_file_id string, modified_at timestamp")
    none = staging.needed_sheets(staging.dim_races(race_list(spark, ["x"]).limit(0)))
    report = staging.sheet_report(staging.resolve_sheets(none, inventory), inventory).collect()
    assert [tuple(r) for r in report] == [("orphaned", None, None, "prep_results_a", "f1")]
    needed = staging.needed_sheets(staging.dim_races(race_list(spark, ["a", "a"])))
    missing = staging.sheet_report(staging.resolve_sheets(needed, inventory.limit(0)), inventory.limit(0)).collect()
    assert sorted(r["race_id"] for r in missing) == ["r0", "r1"] and {r["problem"] for r in missing} == {"missing"}


def test_store_opens_new_and_changed_files_only(spark, tmp_path):
    root, header = tmp_path / "book", ["Name", "Race Time"]
    part = {t: root / f"prep_results_{t}" / "part.csv" for t in ("old one", "changed", "gone", "unwanted")}
    for path in part.values():
        write_csv(path, [header, ["Ann", "10:00"]])
    titles = spark.createDataFrame([(f"prep_results_{t}",) for t in ("old one", "changed", "gone", "new [1]+%")], "sheet_name string")

    def names(rows):
        return sorted((r["sheet_name"].removeprefix("prep_results_"), r["name_raw"]) for r in rows.collect())

    store = sheets.SheetStore(spark, str(tmp_path / "store"))
    assert names(store.read(str(root), titles)) == [("changed", "Ann"), ("gone", "Ann"), ("old one", "Ann")]
    assert store.seen().count() == 3  # the unwanted file was not opened

    # other content of the same length and time of change: it shows if the file is opened again
    before = part["old one"].stat()
    part["old one"].write_bytes(part["old one"].read_bytes().replace(b"Ann", b"Bob"))
    os.utime(part["old one"], ns=(before.st_atime_ns, before.st_mtime_ns))
    write_csv(part["changed"], [header, ["Carl", "11:00"], ["Ann", "10:00"]])
    part["gone"].unlink()
    write_csv(root / "prep_results_new [1]+%" / "part.csv", [["Elapsed", "Skier Name"], ["12:00", "Di"]])
    # a read that was cut off before it listed its files leaves rows that do not count
    spark.read.parquet(f"{store.folder}/rows").drop("batch").write.parquet(f"{store.folder}/rows/batch=cut-off")
    again = sheets.SheetStore(spark, str(tmp_path / "store"))
    want = [("changed", "Ann"), ("changed", "Carl"), ("new [1]+%", "Di"), ("old one", "Ann")]
    assert names(again.read(str(root), titles)) == want
    assert again.seen().count() == 5
    batches = again.seen().select("batch").distinct().count()
    assert names(again.read(str(root), titles)) == want
    assert again.seen().select("batch").distinct().count() == batches == 2  # nothing new, nothing read
    assert names(again.read(str(root), titles.limit(0))) == []


def test_unwanted_sheets_are_not_in_the_scan(spark, book):
    files = sheets.files_of(sheets.listed_files(spark, book, folders=False), spark.createDataFrame([("prep_results_two",)], "sheet_name string"))
    assert len(files) == 1
    rows = sheets.read_sheets(spark, book, folders=False, files=files)
    assert [r["name_raw"] for r in rows.collect()] == ["Cy"]
    scan = sheets._only(spark.read.text(book), files)
    # each small file has a split of its own, so splits count the files of the scan
    assert (scan.rdd.getNumPartitions(), spark.read.text(book).rdd.getNumPartitions()) == (1, 3)
    assert sheets.read_sheets(spark, book, folders=False, files=[]).count() == 0


def test_companion_schema(spark, tmp_path):
    table = spark.createDataFrame([("a", 9, True, 1.5, 'say "x", y'), ("b", None, False, None, None)], "k string, n bigint, b boolean, d double, t string")
    described = prep.with_descriptions(table, {"n": "a number"})
    prep.write_prep_table(described, str(tmp_path / "t"), str(tmp_path / "s"))
    back = prep.read_prep_table(spark, str(tmp_path / "t"), str(tmp_path / "s"))
    assert back.dtypes == table.dtypes and back.schema["n"].metadata == {"comment": "a number"}
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_staging_refuses_ambiguous_titles(spark, book):
    inventory = spark.createDataFrame(
        [("prep_results_one", "f1", None), ("prep_results_one", "f2", None)], "sheet_name string, source_file_id string, modified_at timestamp"
    )
    with pytest.raises(CheckFailed):
        staging.staged_results(book, race_list(spark, ["prep_results_one"]), inventory)


def test_dates_that_do_not_parse(spark):
    races = race_list(spark, ["a", "b"]).withColumn("date", F.when(F.col("race_id") == "r1", F.lit("soon")).otherwise(F.lit("2026-01-05 10:00:00")))
    assert [str(r[0]) for r in staging.dim_races(races).orderBy("race_id").select("race_date").collect()] == ["2026-01-05", "None"]


def test_apply_schema(spark):
    df = spark.createDataFrame(
        [("1", "2.0", "true", "x", ""), ("", "", "", "", ""), ("3", "4", "false", "7", "")], "a string, b string, c string, d string, e string"
    )
    with pytest.warns(UserWarning, match="'d'"):
        out = prep.apply_schema(df, {"a": "int64", "b": "Int64", "c": "boolean", "d": "int64", "gone": "int64"})
    assert dict(out.dtypes) == {"a": "bigint", "b": "bigint", "c": "boolean", "d": "string"}
    assert [tuple(r) for r in out.collect()] == [(1, 2, True, "x"), (3, 4, False, "7")]
    with pytest.warns(UserWarning, match="unknown type 'Int32'"):
        assert prep.apply_schema(df, {"a": "Int32", "b": "bigint"}).dtypes[:2] == [("a", "string"), ("b", "bigint")]


@pytest.fixture
def house(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS house LOCATION '{tmp_path}/house'")
    yield Warehouse(spark, "house", "dev", "2026-01-02_03-04-05")
    spark.sql("DROP DATABASE house CASCADE")


def test_names():
    names = TableNames("Dim Races!", "prod", "2026-01-02_03-04-05")
    assert (names.primary, names.temp, names.archive) == ("dimraces", "__dimraces_temp", "_dimraces_2026-01-02_03-04-05".replace("-", ""))
    assert TableNames("t", "dev").primary == "t_dev"
    with pytest.raises(ValueError):
        TableNames("!!")


def test_publish(spark, house):
    one, two = spark.range(1).toDF("x"), spark.range(2).toDF("x")
    with pytest.raises(ValueError):
        house.read_table("t")
    assert house.write_table("t", [one, two], descriptions={"x": "a number"}) == {"status": "success", "table": "t", "row_count": 3}
    assert house.read_latest_or_temp("t").count() == 3
    assert house.read_latest_or_temp("t").schema["x"].metadata["comment"] == "a number"
    assert house.publish_tables() == ["t_dev"]
    assert house.read_table("t").count() == 3
    house.write_table("t", two)
    house.publish_tables()
    assert house.read_table("t").count() == 2
    assert spark.table(house.qualified(house.names("t").archive)).count() == 3
    house.write_table("t", one)
    house.publish_tables(archive_previous=False)
    assert house.read_table("t").count() == 1
    with pytest.raises(ValueError):
        house.write_table("t", [])
    with pytest.raises(TypeError):
        house.write_table("t", [1])


def test_archives_stay(spark, house):
    for n in (1, 2, 3, 4):
        house.write_table("t", spark.range(n).toDF("x"))
        house.publish_tables()
    assert [spark.table(house.qualified(p)).count() for _, status, _, p in house.manifest() if status == "archived"] == [1, 2, 3]
    assert house.read_archive("t").count() == 3 and spark.table(house.qualified("t_dev")).count() == 4
    house.write_table("t", spark.range(9).toDF("x"))
    house.write_table("t", spark.range(8).toDF("x"))  # the version that waited is replaced
    house.publish_tables()
    assert house.read_table("t").count() == 8
    with pytest.raises(ValueError):
        house.read_archive("other")


def test_a_table_from_before_the_manifest(spark, house):
    spark.range(6).toDF("x").write.saveAsTable(house.qualified("t_dev"))
    assert house.read_table("t").count() == 6
    house.write_table("t", spark.range(2).toDF("x"))
    house.publish_tables()
    assert house.read_table("t").count() == 2 and house.read_archive("t").count() == 6


def counts(house):
    return {(base, status, label): house.spark.table(house.qualified(physical)).count() for base, status, label, physical in house.manifest()}


def test_a_failure_at_any_step_leaves_the_old_versions(spark, house, monkeypatch):
    """Statement after statement of the catalog fails; readers see all the old versions or all the new ones."""
    for n in (1, 2):
        for name in ("a", "b"):
            house.write_table(name, spark.range(n).toDF("x"))
        house.publish_tables()
    before, step = counts(house), 0
    sql = type(spark).sql
    while True:
        for name in ("a", "b"):
            house.write_table(name, spark.range(5).toDF("x"))
        left = [step]

        def failing(self, query, *args, **named):
            if left[0] == 0:
                raise RuntimeError("lost the catalog")
            left[0] -= 1
            return sql(self, query, *args, **named)

        monkeypatch.setattr(type(spark), "sql", failing)
        try:
            house.publish_tables()
            failed = False
        except RuntimeError:
            failed = True
        monkeypatch.undo()
        seen = (house.read_table("a").count(), house.read_table("b").count())
        assert seen in ((2, 2), (5, 5)) and all(counts(house)[k] for k in before if k[1] == "archived")
        if seen == (2, 2):
            assert failed and counts(house) == before and house.read_latest_or_temp("a").count() == 5
        else:
            break
        step += 1
    house.refresh_names()
    assert spark.table(house.qualified("a_dev")).count() == spark.table(house.qualified("b_dev")).count() == 5
    assert house.read_archive("a").count() == 2
