"""Scans, sources, sinks. Files and tables are written from the given tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..session import scratch_path
from ..sources import prep, sheets
from ..sources.warehouse import Warehouse
from .registry import query

# Sheets of the series A* have one set of headers, all others another, with columns in another order.
FIRST_LAYOUT = {"name": "Name", "time": "Race Time", "usss": "USSS#", "school": "School", "remark": "Remark"}
SECOND_LAYOUT = {"remark": "Remark", "name": "Skier Name", "time": "Elapsed", "usss": "Member #"}
IN_FIRST = "series LIKE 'A%'"


def write_sheets(fx: Fixtures, table: str = "sheet_rows") -> str:
    """Result sheets as CSV, one folder per sheet, in two layouts; returns their folder."""
    whole = getattr(fx, table)
    root = scratch_path(fx.spark, "book") + "/sheets"
    for layout, rows in (
        (FIRST_LAYOUT, whole.filter(IN_FIRST)),
        (SECOND_LAYOUT, whole.filter(f"NOT {IN_FIRST}")),
    ):
        columns = [F.col(c).alias(header) for c, header in layout.items()]
        # by range and into a fixed number: two large sheets do not meet in a task, and a sheet stays one file
        tasks = int(fx.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.select("sheet_name", *columns).repartitionByRange(tasks, "sheet_name")
        rows.write.mode("append").partitionBy("sheet_name").csv(root, header=True, escape='"')
    return root


@query(
    """SELECT name AS "Name", time AS "Race Time", usss AS "USSS#", school AS "School", remark AS "Remark" FROM sheet_rows"""
)
def scan_csv_all_string(fx: Fixtures) -> DataFrame:
    path = scratch_path(fx.spark, "sheet")
    columns = [F.col(c).alias(header) for c, header in FIRST_LAYOUT.items()]
    fx.sheet_rows.select(*columns).write.csv(path, header=True, escape='"')
    return sheets.scan_csv_text(fx.spark, path)


@query("SELECT DISTINCT sheet_name FROM sheet_rows")
def file_inventory(fx: Fixtures) -> DataFrame:
    table = sheets.file_inventory(fx.spark, write_sheets(fx), folders=True)
    return table.filter("source_file_id IS NOT NULL AND modified_at IS NOT NULL").select("sheet_name")


@query("SELECT DISTINCT sheet_name AS race_id, 'files' AS source_type FROM sheet_rows")
def file_inventory_recursive(fx: Fixtures) -> DataFrame:
    above = write_sheets(fx).rsplit("/", 1)[0]
    table = sheets.infra_result_files(sheets.file_inventory(fx.spark, above, recursive=True, folders=True))
    return table.filter("file_id IS NOT NULL AND modified_at IS NOT NULL").select("race_id", "source_type")


STANDARD = """SELECT sheet_name, name AS name_raw, time AS time_raw, usss AS usss_id, CAST(NULL AS VARCHAR) AS fis_id,
  CASE WHEN series LIKE 'A%' THEN school END AS school_raw, CAST(NULL AS VARCHAR) AS team_raw, CAST(NULL AS VARCHAR) AS state_raw
FROM sheet_rows"""


@query(STANDARD)
def standardize_columns(fx: Fixtures) -> DataFrame:
    return sheets.read_sheets(fx.spark, write_sheets(fx))


@query(STANDARD)
def incremental_sheets(fx: Fixtures) -> DataFrame:
    """All sheets through a store that has read those of the series A* before."""
    root = write_sheets(fx)
    store = sheets.SheetStore(fx.spark, scratch_path(fx.spark, "sheet-store"))
    store.refresh(root, fx.sheet_rows.filter(IN_FIRST).select("sheet_name"))
    return store.read(root)


@query(STANDARD)
def union_by_name(fx: Fixtures) -> DataFrame:
    frames = []
    for layout, condition in ((FIRST_LAYOUT, IN_FIRST), (SECOND_LAYOUT, f"NOT {IN_FIRST}")):
        columns = [F.col(c).alias(header) for c, header in layout.items()]
        frame = fx.sheet_rows.filter(condition).select("sheet_name", *columns)
        standard = frame.select("sheet_name", *sheets.standardize_columns(frame))
        # columns without any source are left out here: the union fills them
        frames.append(standard if layout is FIRST_LAYOUT else standard.drop("school_raw", "team_raw"))
    return sheets.union_sheets(frames, frames[0].schema)


RACE_LIST_SCHEMA = """race_id string, date string, name string, series string, technique string, discipline string, format string,
  division string, venue string, state string, boys_results_name string, girls_results_name string"""


@query("SELECT race_id, race_season, date, name, series FROM race_list WHERE race_season >= 2022")
def scan_seasons(fx: Fixtures) -> DataFrame:
    root = scratch_path(fx.spark, "seasons")
    fx.race_list.write.partitionBy("race_season").csv(root, header=True, escape='"')
    book = prep.scan_seasons(fx.spark, root, RACE_LIST_SCHEMA)
    return book.filter("race_season >= 2022").select("race_id", "race_season", "date", "name", "series")


@query("SELECT series, CAST(is_point_generating AS BOOLEAN) AS is_point_generating, compression_factor_di, compression_factor_sp FROM point_series")
def scan_prep_table(fx: Fixtures) -> DataFrame:
    path = scratch_path(fx.spark, "prep")
    fx.point_series.write.csv(path, header=True)
    schema = "series string, is_point_generating boolean, compression_factor_di double, compression_factor_sp double"
    return prep.scan_prep_table(
        fx.spark, path, prep_order(fx.point_series, schema)
    )


def prep_order(df: DataFrame, ddl: str) -> str:
    """The schema's fields in the order of the stored columns (CSV is read by position)."""
    fields = {f.split()[0]: f for f in (part.strip() for part in ddl.split(","))}
    return ", ".join(fields[c] for c in df.columns)


def warehouse(fx: Fixtures, env: str = "prod", timestamp: str | None = None) -> Warehouse:
    database = f"seedline_{uuid.uuid4().hex[:12]}"
    fx.spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(fx.spark, database)}'")
    return Warehouse(fx.spark, database, env, timestamp)


def halves(df: DataFrame) -> list[DataFrame]:
    return [df.filter("race_season < 2024"), df.filter("race_season >= 2024")]


@query("SELECT race_id, race_season, series FROM dim_races")
def write_table(fx: Fixtures) -> DataFrame:
    house = warehouse(fx)
    rows = fx.dim_races.select("race_id", "race_season", "series")
    house.write_table("Dim Races!", halves(rows), lifecycle=False, descriptions={"race_id": "Unique race identifier"})
    return house.read_table("dimraces")


@query("SELECT registration_id, race_season, is_ghost_registration, grade FROM dim_registrations")
def read_table(fx: Fixtures) -> DataFrame:
    house = warehouse(fx, "dev")
    rows = fx.dim_registrations.select("registration_id", "race_season", "is_ghost_registration", "grade")
    house.write_table("dim_registrations", rows, lifecycle=False)
    return house.read_table("dim_registrations")


@query("SELECT race_id, series FROM dim_races WHERE race_season >= 2024")
def read_latest_or_temp(fx: Fixtures) -> DataFrame:
    house = warehouse(fx)
    old, new = (part.select("race_id", "series") for part in halves(fx.dim_races))
    house.write_table("dim_races", old, lifecycle=False)
    house.write_table("dim_races", new)
    return house.read_latest_or_temp("dim_races")


@query(
    """SELECT 'published' AS version, race_id FROM dim_races WHERE race_season >= 2024
UNION ALL SELECT 'archived', race_id FROM dim_races WHERE race_season < 2024"""
)
def publish_tables(fx: Fixtures) -> DataFrame:
    house = warehouse(fx, timestamp="2026-01-02_03-04-05")
    for part in halves(fx.dim_races.select("race_id", "race_season")):
        house.write_table("dim_races", part.select("race_id"))
        house.publish_tables()
    published = house.read_table("dim_races").withColumn("version", F.lit("published"))
    archived = house.read_archive("dim_races", house.names("dim_races").archive)
    return published.unionByName(archived.withColumn("version", F.lit("archived")))


@query("SELECT registration_id, race_season, is_ghost_registration, grade, school, birth_year FROM dim_registrations")
def schema_companion(fx: Fixtures) -> DataFrame:
    """A typed table through text and back: the types come from the companion table alone."""
    path = scratch_path(fx.spark, "typed")
    table = fx.dim_registrations.select("registration_id", "race_season", "is_ghost_registration", "grade", "school", "birth_year")
    prep.write_prep_table(prep.with_descriptions(table, {"grade": "School grade, 7 to 12"}), path, f"{path}-schema")
    return prep.read_prep_table(fx.spark, path, f"{path}-schema")


@query(
    """SELECT registration_id, race_season, is_ghost_registration, grade, school, CAST(birth_year AS VARCHAR) || '?' AS birth_year
FROM dim_registrations"""
)
def apply_schema(fx: Fixtures) -> DataFrame:
    table = fx.dim_registrations
    text = table.select(
        "registration_id",
        *[F.col(c).cast("string") for c in ("race_season", "is_ghost_registration")],
        F.col("grade").cast("double").cast("string").alias("grade"),  # 9.0, as a stored nullable number
        F.coalesce("school", F.lit("")).alias("school"),
        F.concat(F.col("birth_year").cast("string"), F.lit("?")).alias("birth_year"),  # does not convert
        F.lit("").alias("nothing"),
    )
    dtypes = {"race_season": "int64", "is_ghost_registration": "boolean", "grade": "Int64", "birth_year": "Int64"}
    return prep.apply_schema(text, {**dtypes, "school": "string", "absent": "float64"})


@query("SELECT 'success' AS status, 'stg_results' AS table_name, count(*) AS row_count FROM dim_results")
def row_count_metric(fx: Fixtures) -> DataFrame:
    metric = warehouse(fx).write_table("stg_results", fx.dim_results.select("result_id", "race_id"))
    row = (metric["status"], metric["table"], metric["row_count"])
    return fx.spark.createDataFrame([row], "status string, table_name string, row_count long")
