"""A season from files to standings, in stages that survive a lost driver.

Each stage writes its table to the run's folder and then one row of metrics. A stage with a row is whole: a run that was cut
off is started again on the same folder and goes on after the last whole stage, without reading the files of that stage again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.sheets import SheetStore
from . import penalties, registrations, results, slots, staging, standings, windows
from .points import ext_results

METRICS = "status string, table_name string, row_count long"


@dataclass
class Inputs:
    """``names`` and ``schools`` are spelling lookups; without ``athlete_penalties`` both models are fitted.

    With ``sheet_store`` a run opens only the sheets that are new or changed since the store's last read.
    """

    sheets: str
    race_list: DataFrame
    inventory: DataFrame
    registrations: DataFrame
    names: DataFrame
    schools: DataFrame
    non_people: DataFrame
    publications: DataFrame
    contribution_windows: DataFrame
    point_series: DataFrame
    athlete_penalties: DataFrame | None = None
    sheet_store: SheetStore | None = None


class StagedRun:
    """Stages of one run under one shared folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder or scratch_path(spark, "season")
        self._add_metrics([])  # the table of metrics exists from the start

    def _add_metrics(self, rows: list[tuple[str, str, int]]) -> None:
        self.spark.createDataFrame(rows, METRICS).write.mode("append").parquet(f"{self.folder}/metrics")

    def metrics(self) -> DataFrame:
        """One row per whole stage: status, table_name, row_count."""
        return self.spark.read.schema(METRICS).parquet(f"{self.folder}/metrics")

    def is_whole(self, name: str) -> bool:
        return not self.metrics().filter(F.col("table_name") == name).isEmpty()

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage, built only if an earlier start did not finish it."""
        path = f"{self.folder}/{name}"
        if not self.is_whole(name):
            counted = Observation()
            table = build().observe(counted, F.count(F.lit(1)).alias("n"))
            table.write.mode("overwrite").parquet(path)
            self._add_metrics([("success", name, counted.get["n"])])
        return self.spark.read.parquet(path)


def files_to_standings(run: StagedRun, given: Inputs) -> DataFrame:
    """The whole chain: staged sheets, results, registrations, penalties, points, slots, standings."""
    staged = cache(lambda: staging.staged_results(given.sheets, given.race_list, given.inventory, given.sheet_store))
    races = run.stage("dim_races", lambda: staged()[1])
    raw = run.stage("stg_results", lambda: staged()[0])
    table = run.stage("dim_results", lambda: results.dim_results(raw, races, given.names, given.schools, given.non_people))
    people = run.stage("dim_registrations", lambda: registrations.dim_registrations(given.registrations, given.names, given.schools))

    def fitted() -> DataFrame:
        counting = windows.races_by_penalty_window(given.publications, given.contribution_windows, races)
        return penalties.build_penalties(people, table, counting)[1]

    lists = run.stage("athlete_penalties", fitted if given.athlete_penalties is None else lambda: given.athlete_penalties)
    scored = run.stage("ext_results", lambda: ext_results(given.point_series, lists, table, races, people))
    counted = run.stage("points_contributing", lambda: slots.points_contributing_results(scored, people))
    return run.stage("ext_registrations", lambda: standings.ext_registrations(counted, people))
