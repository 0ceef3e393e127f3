"""Race list, sheet mapping and staged results."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import GENDERS, SHEET_CSV_URL, SHEET_EDIT_URL, SHEET_PREFIX
from ..functions.text import strip
from ..operators import checks
from ..session import durable
from ..sources.sheets import SheetStore, files_of, listed_files, read_sheets

OPTIONAL_RACE_COLUMNS = {
    "boys_result_sheet_url": "results_pdf_url_b",
    "girls_result_sheet_url": "results_pdf_url_g",
    "boys_results_name": "prep_results_table_b",
    "girls_results_name": "prep_results_table_g",
}


def dim_races(races: DataFrame) -> DataFrame:
    """Typed race table from the season race lists; unreadable dates become NULL."""
    optional = [
        (F.col(name) if name in races.columns else F.lit(None)).cast("string").alias(alias)
        for name, alias in OPTIONAL_RACE_COLUMNS.items()
    ]
    return races.select(
        F.col("race_id").cast("string"),
        F.to_date(F.try_to_timestamp(F.col("date").cast("string"))).alias("race_date"),
        F.col("race_season").cast("bigint"),
        F.col("name").alias("race_name"),
        "series",
        "technique",
        "discipline",
        F.col("format").alias("race_format"),
        "division",
        "venue",
        "state",
        *optional,
    )


def dev_sample(races: DataFrame, seed: int = 0) -> DataFrame:
    """One random race per (season, series), for development runs; drawn by digest, so that any engine can repeat it."""
    dice = F.md5(F.concat(F.lit(f"{seed},"), "race_id"))
    # min_by combines before the shuffle, so a series holding most races is no hot group
    whole = F.struct(*races.columns)
    picked = races.groupBy("race_season", "series").agg(F.min_by(whole, dice).alias("row"))
    return picked.select("row.*")


def needed_sheets(races: DataFrame) -> DataFrame:
    """One row per race and gender that names a sheet."""
    long = races.unpivot(
        "race_id",
        [F.col(f"prep_results_table_{g}").alias(g) for g in GENDERS],
        "gender",
        "sheet_name",
    )
    title = strip(F.col("sheet_name"))
    return long.withColumn("sheet_name", title).filter("sheet_name <> ''")


def resolve_sheets(needed: DataFrame, inventory: DataFrame) -> DataFrame:
    """Attach the file of each sheet title and its addresses (NULL when there is no such file)."""
    files = inventory.select("sheet_name", "source_file_id", "modified_at")
    return needed.join(files, "sheet_name", "left").withColumns(
        {
            "prep_results_url": _address(SHEET_EDIT_URL),
            "gviz_csv_url": _address(SHEET_CSV_URL),
        }
    )


def _address(around: tuple[str, str]):
    return F.concat(F.lit(around[0]), F.col("source_file_id"), F.lit(around[1]))


def check_inventory(inventory: DataFrame, prefix: str = SHEET_PREFIX) -> DataFrame:
    """Titles that stand for more than one file."""
    return checks.several_values(
        inventory.filter(F.col("sheet_name").startswith(prefix)), ["sheet_name"], "source_file_id"
    )


def check_mapping(resolved: DataFrame) -> DataFrame:
    """(race, gender) pairs that do not map to exactly one sheet."""
    return checks.not_one_row(resolved, ["race_id", "gender"])


def sheet_report(resolved: DataFrame, inventory: DataFrame, prefix: str = SHEET_PREFIX) -> DataFrame:
    """Sheets that do not meet: ``missing`` ones a race asks for, ``orphaned`` ones that no race asks for."""
    missing = resolved.filter("source_file_id IS NULL").select(
        F.lit("missing").alias("problem"), "race_id", "gender", "sheet_name", "source_file_id"
    )
    files = inventory.filter(F.col("sheet_name").startswith(prefix))
    none = F.lit(None).cast("string")
    orphaned = checks.unreferenced_files(files, resolved).select(
        F.lit("orphaned").alias("problem"), none.alias("race_id"), none.alias("gender"), "sheet_name", "source_file_id"
    )
    return missing.unionByName(orphaned)


def warn_about_sheets(report: DataFrame, sample: int = 20) -> None:
    """One warning per kind of problem: how many sheets, and the first of them."""
    report = durable(report, "sheet-report")
    counts = {r["problem"]: r["n"] for r in report.groupBy("problem").agg(F.count(F.lit(1)).alias("n")).collect()}
    for problem, n in sorted(counts.items()):
        rows = report.filter(F.col("problem") == problem).orderBy("sheet_name", "race_id", "gender").limit(sample).collect()
        named = [(r["race_id"], r["gender"], r["sheet_name"]) if problem == "missing" else r["sheet_name"] for r in rows]
        left = "skipped" if problem == "missing" else "not in the race list"
        warnings.warn(f"{n} {problem} sheet(s), {left}: {named}", stacklevel=3)


def with_result_urls(races: DataFrame, resolved: DataFrame) -> DataFrame:
    """One address column per gender on the race table."""
    urls = (
        resolved.filter("prep_results_url IS NOT NULL")
        .groupBy("race_id")
        .pivot("gender", GENDERS)
        .agg(F.min("prep_results_url"))
    )
    urls = urls.withColumnsRenamed({g: f"prep_results_url_{g}" for g in GENDERS})
    return races.join(urls, "race_id", "left")


def _wanted_rows(root: str, titles: DataFrame, store: SheetStore | None) -> DataFrame:
    """Standardised rows of the sheets in ``titles`` and of no others; with a store, of new and changed files from the files."""
    spark = titles.sparkSession
    if store is not None:
        return store.read(root, titles)
    return read_sheets(spark, root, files=files_of(listed_files(spark, root), titles))


def staged_results(
    root: str, race_list: DataFrame, inventory: DataFrame, store: SheetStore | None = None
) -> tuple[DataFrame, DataFrame]:
    """(stg_results, dim_races): every sheet a race asks for, in one read, standardised. Other files are not opened,
    and with a ``store`` neither are those that it holds unchanged.

    Fails when a title stands for several files or a race and gender for several sheets;
    warns of sheets that are missing and of files that no race asks for.
    """
    races = dim_races(race_list)
    needed = needed_sheets(races)
    checks.require_none(check_inventory(inventory), "a sheet title stands for several files")
    resolved = resolve_sheets(needed, inventory)
    checks.require_none(check_mapping(resolved), "race and gender must name exactly one sheet")
    warn_about_sheets(sheet_report(resolved, inventory))
    wanted = resolved.filter("source_file_id IS NOT NULL").select(
        "sheet_name", "race_id", "gender", "source_file_id", "prep_results_url"
    )
    wanted = durable(wanted, "wanted-sheets")
    sheets = _wanted_rows(root, wanted, store)
    staged = sheets.join(wanted, "sheet_name").drop("sheet_name")
    return staged.withColumn("created_at", F.current_timestamp()), with_result_urls(races, resolved)


def staged_results_by_file(root: str, files: DataFrame, store: SheetStore | None = None) -> DataFrame:
    """Staging without a race list: the file name is the race id, and there is no gender."""
    named = files.select(F.col("race_id").alias("sheet_name"), "file_id", "race_id")
    sheets = _wanted_rows(root, named, store)
    columns = ["file_id", "race_id", *[c for c in sheets.columns if c != "sheet_name"]]
    return sheets.join(named, "sheet_name").select(*columns, F.current_timestamp().alias("created_at"))


