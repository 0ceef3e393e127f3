"""Result sheets: CSV files of text whose headers differ from sheet to sheet."""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import SHEET_HEADERS, SHEET_PREFIX
from ..session import durable

FILE_TYPE = "csv"


def scan_csv_text(spark: SparkSession, path: str | list[str], *, multi_line: bool = False) -> DataFrame:
    """Files that share one header, every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, escape='"')


def sheet_name_of(path: Column, folders: bool) -> Column:
    """Title of the sheet a file belongs to: its own name, or its folder's when sheets are folders."""
    names = F.split(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "/")
    if folders:
        return F.regexp_replace(F.element_at(names, -2), "^[^=]*=", "")
    return F.regexp_replace(F.element_at(names, -1), r"\.[^.]*$", "")


def file_inventory(
    spark: SparkSession,
    root: str,
    prefix: str = SHEET_PREFIX,
    *,
    recursive: bool = False,
    folders: bool = False,
) -> DataFrame:
    """Files under ``root`` whose sheet name starts with ``prefix``: name, id, time of change.

    Only the listing is read, never the contents. ``recursive`` descends into sub-folders. With
    ``folders`` a sheet is a folder of files instead of one file.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{FILE_TYPE}")
        .option("recursiveFileLookup", str(recursive or folders).lower())
        .load(root)
    )
    if not recursive:
        depth = _depth_of(root) + (2 if folders else 1)
        files = files.filter(F.size(F.split("path", "/")) == depth)
    files = files.select(
        sheet_name_of(F.col("path"), folders).alias("sheet_name"),
        F.col("path").alias("source_file_id"),
        F.col("modificationTime").alias("modified_at"),
    ).filter(F.col("sheet_name").startswith(prefix))
    if not folders:
        return files
    # the parts of one folder are one sheet
    return files.groupBy("sheet_name").agg(
        F.min(F.regexp_replace("source_file_id", "/[^/]*$", "")).alias("source_file_id"),
        F.max("modified_at").alias("modified_at"),
    )


def _depth_of(root: str) -> int:
    """Path parts of ``root`` in the form in which the file source reports paths."""
    return len(root.rstrip("/").replace("file:///", "file:/").split("/"))


def infra_result_files(inventory: DataFrame, source_type: str = "files") -> DataFrame:
    """The inventory as the table of result files, the sheet name being the race id."""
    return inventory.select(
        F.col("sheet_name").alias("race_id"),
        F.col("source_file_id").alias("file_id"),
        "modified_at",
        F.lit(source_type).alias("source_type"),
    )


def standardize_columns(df: DataFrame, headers: dict[str, list[str]] = SHEET_HEADERS) -> list[Column]:
    """For each standard column the first candidate header that exists, else NULL text."""
    columns = []
    for standard, candidates in headers.items():
        hit = next((c for c in candidates if c in df.columns), None)
        column = F.col(f"`{hit}`") if hit else F.lit(None)
        columns.append(column.cast("string").alias(standard))
    return columns


def listed_files(spark: SparkSession, root: str, *, folders: bool = True) -> DataFrame:
    """Files under ``root`` as the readers name them: file, sheet_name, modified_at, length. Only the listing is read."""
    files = _text_files(spark.read.format("binaryFile"), folders).load(root)
    name = sheet_name_of(F.col("_metadata.file_path"), folders)
    return files.select(
        F.col("_metadata.file_path").alias("file"),
        name.alias("sheet_name"),
        F.col("modificationTime").alias("modified_at"),
        "length",
    )


def files_of(files: DataFrame, titles: DataFrame) -> list[str]:
    """Those of ``listed_files`` that belong to sheets in ``titles`` (sheet_name).

    The names go to the driver, whose file index holds an entry for every file in any case.
    """
    return sorted(r["file"] for r in files.join(titles.select("sheet_name").distinct(), "sheet_name", "left_semi").select("file").collect())


def _only(df: DataFrame, files: list[str] | None) -> DataFrame:
    """Rows of the named files; the file index leaves the others out of the scan, so they are never opened."""
    return df if files is None else df.filter(F.col("_metadata.file_path").isin(files))


def header_lines(spark: SparkSession, root: str, *, folders: bool = True, files: list[str] | None = None) -> DataFrame:
    """The first line with text of every file: file, header. One row per file, written down once."""
    lines = _only(_text_files(spark.read, folders).text(root), files)
    lines = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    # the first block of a file lies in one task, where line numbers ascend
    first = lines.filter("block = 0 AND trim(value) <> ''").groupBy("file")
    return durable(first.agg(F.min_by("value", "line").alias("header")), "headers")


def _text_files(reader, folders: bool):
    return reader.option("recursiveFileLookup", str(folders).lower()).option("pathGlobFilter", f"*.{FILE_TYPE}")


def read_sheets(
    spark: SparkSession,
    root: str,
    headers: dict[str, list[str]] = SHEET_HEADERS,
    *,
    folders: bool = True,
    multi_line: bool = False,
    files: list[str] | None = None,
) -> DataFrame:
    """All sheets under ``root`` in one scan, whatever their headers: sheet_name + standard columns.

    The files are read by position and each row looks its file's header up to find its columns, so
    there is no loop over files. ``files`` (see ``files_of``) leaves all others unread. No sheets, no rows.
    """
    return _sheet_rows(spark, root, headers, folders, multi_line, files).drop("file")


def _sheet_rows(
    spark: SparkSession, root: str, headers: dict[str, list[str]], folders: bool, multi_line: bool, files: list[str] | None
) -> DataFrame:
    """``read_sheets`` with the file of each row."""
    lines = header_lines(spark, root, folders=folders, files=files)
    width = lines.agg(F.max(F.size(F.split("header", ",")))).first()[0]
    standard = T.StructType([T.StructField(c, T.StringType()) for c in ["file", "sheet_name", *headers]])
    if width is None:
        return spark.createDataFrame([], standard)
    places = [f"_c{i}" for i in range(width)]
    parsed = F.from_csv("header", ", ".join(f"{c} STRING" for c in places), {"escape": '"'})
    cells = F.array(*[F.trim(parsed[c]) for c in places])
    head = lines.select("file", sheet_name_of(F.col("file"), folders).alias("sheet_name"), cells.alias("cells"))

    positions = []
    for name, candidates in headers.items():
        found = [F.nullif(F.array_position("cells", c), F.lit(0)) for c in candidates]
        positions.append(F.coalesce(*found).cast("int").alias(f"_at_{name}"))
    layout = head.select("file", "sheet_name", *positions)

    schema = T.StructType([T.StructField(c, T.StringType()) for c in places])
    scan = _text_files(spark.read, folders).schema(schema).csv(root, header=True, multiLine=multi_line, escape='"')
    rows = _only(scan, files).withColumn("file", F.col("_metadata.file_path"))
    cells = F.array(*[F.col(c) for c in places])
    values = [
        F.nullif(F.get(cells, F.col(f"_at_{name}") - 1), F.lit("")).alias(name) for name in headers
    ]
    return rows.join(layout, "file").select("file", "sheet_name", *values)


class SheetStore:
    """Standardised rows of sheets kept by file, time of change and length: a later read opens new and changed files only.

    A read writes the rows of the files it opened as one batch and then lists those files under the batch. A batch without
    a list, left by a read that was cut off, is never used. Rows of files that changed or are gone are left out.
    """

    SEEN = "file string, modified_at timestamp, length bigint, batch string"

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        headers: dict[str, list[str]] = SHEET_HEADERS,
        *,
        folders: bool = True,
        multi_line: bool = False,
    ) -> None:
        self.spark, self.headers, self.folders, self.multi_line = spark, headers, folders, multi_line
        # rows read by other rules are not these rows
        rules = hashlib.md5(json.dumps([headers, folders, multi_line]).encode()).hexdigest()
        self.folder = f"{folder}/{rules}"
        spark.createDataFrame([], self.SEEN).write.mode("append").parquet(f"{self.folder}/seen")

    def seen(self) -> DataFrame:
        """Every version of a file that was read whole, and its batch."""
        table = self.spark.read.schema(self.SEEN).parquet(f"{self.folder}/seen")
        # two reads at once may both have read a file: one of them counts
        return table.groupBy("file", "modified_at", "length").agg(F.max("batch").alias("batch"))

    def refresh(self, root: str, titles: DataFrame | None = None) -> DataFrame:
        """Read what is new; returns the files now standing for the sheets in ``titles`` (all without): file, batch."""
        files = listed_files(self.spark, root, folders=self.folders)
        if titles is not None:
            files = files.join(titles.select("sheet_name").distinct(), "sheet_name", "left_semi")
        files = durable(files, "listed-files")  # one listing decides what is read and what counts
        version = ["file", "modified_at", "length"]
        fresh = files.join(self.seen(), version, "left_anti").select(*version)
        names = sorted(r["file"] for r in fresh.collect())
        if names:
            batch = uuid.uuid4().hex
            rows = _sheet_rows(self.spark, root, self.headers, self.folders, self.multi_line, names)
            rows.write.parquet(f"{self.folder}/rows/batch={batch}")
            fresh = durable(fresh.withColumn("batch", F.lit(batch)), "fresh-files")
            fresh.write.mode("append").parquet(f"{self.folder}/seen")
        return files.join(self.seen(), version).select("file", "batch")

    def read(self, root: str, titles: DataFrame | None = None) -> DataFrame:
        """As ``read_sheets``, of the sheets in ``titles`` (all without)."""
        current = durable(self.refresh(root, titles), "current-files")
        columns = ["file", "sheet_name", *self.headers]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "batch"]])
        if current.isEmpty():
            return self.spark.createDataFrame([], schema).select("sheet_name", *self.headers)
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/rows")
        return rows.join(current, ["file", "batch"], "left_semi").select("sheet_name", *self.headers)


def union_sheets(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Rows of all frames matched by column name; no frames give an empty table of ``schema``."""
    if not frames:
        return SparkSession.active().createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
