"""Catalog tables that are written beside the current ones and then published together.

Every write makes a table of its own. Which one a reader gets stands in the manifest, a view of literal rows (one per version
of a table) that a single catalog statement replaces: all tables of a run change hands at once, and whatever fails before that
statement leaves every former version, archives included, as it was. Names for SQL users (a view per published table) follow the manifest
and can be made again from it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .prep import with_descriptions


def plain_name(name: str) -> str:
    """Letters, digits, ``_`` and ``+`` only, in lower case."""
    return re.sub(r"[^a-zA-Z0-9_+]", "", name).lower()


class TableNames:
    """Names of the three versions of a table in an environment."""

    def __init__(self, table: str, env: str = "prod", timestamp: str | None = None) -> None:
        base = plain_name(table)
        if not base:
            raise ValueError(f"table name {table!r} has no usable character")
        suffix = "" if env.lower() == "prod" else f"_{plain_name(env)}"
        stamp = plain_name(timestamp or datetime.now(timezone.utc).strftime("%Y-%m-%d_%H-%M-%S"))
        self.base = base
        self.primary = f"{base}{suffix}"
        self.temp = f"__{base}_temp{suffix}"
        self.archive = f"_{base}{suffix}_{stamp}"


PUBLISHED, ARCHIVED = "published", "archived"


class Warehouse:
    """Tables of one database and environment."""

    def __init__(
        self, spark: SparkSession, database: str, env: str = "prod", timestamp: str | None = None
    ) -> None:
        self.spark, self.database, self.env, self.timestamp = spark, database, env, timestamp
        self.pending: dict[str, tuple[TableNames, str]] = {}
        suffix = "" if env.lower() == "prod" else f"_{plain_name(env)}"
        self.manifest_name = f"__manifest{suffix}"

    def names(self, table: str) -> TableNames:
        return TableNames(table, self.env, self.timestamp)

    def qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    # --- manifest ----------------------------------------------------------------------

    def manifest(self) -> list[tuple[str, str, str, str]]:
        """(table, status, label, physical name) of every version, oldest first; the label of an archive is its name."""
        if not self.exists(self.manifest_name):
            return []
        rows = self.spark.table(self.qualified(self.manifest_name)).orderBy("place").collect()
        return [(r.base, r.status, r.label, r.physical) for r in rows]

    def _replace_manifest(self, versions: list[tuple[str, str, str, str]]) -> None:
        """The one statement by which readers move from the old versions to the new ones."""
        values = ", ".join(f"({place}, '{b}', '{s}', '{l}', '{p}')" for place, (b, s, l, p) in enumerate(versions))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.qualified(self.manifest_name)} AS "
            f"SELECT * FROM VALUES {values} AS versions(place, base, status, label, physical)"
        )

    def _current(self, names: TableNames) -> str | None:
        """The physical name of the published version; a table that was there before the manifest counts as one."""
        found = [p for b, s, _, p in self.manifest() if b == names.base and s == PUBLISHED]
        if found:
            return found[-1]
        return names.primary if self.exists(names.primary) else None

    # --- writing and reading -------------------------------------------------------------

    def write_table(
        self,
        table: str,
        data: DataFrame | Iterable[DataFrame],
        *,
        lifecycle: bool = True,
        descriptions: dict[str, str] | None = None,
        partition_by: str | None = None,
    ) -> dict:
        """Write the first frame as a new version, append the others; returns status and row count.

        With ``lifecycle`` the version waits for ``publish_tables``, else it is published at once in place of the former one.
        """
        names = self.names(table)
        target = f"{names.temp}_{uuid.uuid4().hex}"
        rows, mode = 0, "errorifexists"
        for frame in [data] if isinstance(data, DataFrame) else data:
            if not isinstance(frame, DataFrame):
                raise TypeError("data must be a DataFrame or an iterable of DataFrames")
            described = with_descriptions(frame, descriptions or {})
            rows += self._write(described, target, mode, partition_by)
            mode = "append"
        if mode == "errorifexists":
            raise ValueError("data must hold at least one DataFrame")
        before = self.pending.pop(names.base, None)
        if lifecycle:
            self.pending[names.base] = (names, target)
        else:
            self._publish([(names, target)], archive_previous=False)
        if before:
            self._drop(before[1])
        return {"status": "success", "table": table, "row_count": rows}

    def _write(self, frame: DataFrame, target: str, mode: str, partition_by: str | None) -> int:
        counted = Observation()
        writer = frame.observe(counted, F.count(F.lit(1)).alias("n")).write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.saveAsTable(self.qualified(target))
        return counted.get["n"]

    def read_table(self, table: str) -> DataFrame:
        """The published version."""
        name = self._current(self.names(table))
        if name is None:
            raise ValueError(f"no table {table!r} in the {self.env} environment")
        return self.spark.table(self.qualified(name))

    def read_archive(self, table: str, label: str | None = None) -> DataFrame:
        """The version archived last, under the given name or any."""
        base = self.names(table).base
        found = [p for b, s, l, p in self.manifest() if b == base and s == ARCHIVED and label in (None, l)]
        if not found:
            raise ValueError(f"no archived version of {table!r} in the {self.env} environment")
        return self.spark.table(self.qualified(found[-1]))

    def read_latest_or_temp(self, table: str) -> DataFrame:
        """The version written by this run if there is one, else the published one."""
        pending = self.pending.get(self.names(table).base)
        return self.spark.table(self.qualified(pending[1])) if pending else self.read_table(table)

    # --- publishing ----------------------------------------------------------------------

    def publish_tables(self, *, archive_previous: bool = True) -> list[str]:
        """Make every waiting version the published one, all in one step; the former ones are archived or dropped.

        A failure before that step changes nothing for readers, and the versions go on waiting.
        """
        pending = list(self.pending.values())
        for names, physical in pending:
            if not self.exists(physical):
                raise ValueError(f"TEMP version of {names.base!r} is missing")
        self._publish(pending, archive_previous=archive_previous)
        return [names.primary for names, _ in pending]

    def _publish(self, fresh: list[tuple[TableNames, str]], *, archive_previous: bool) -> None:
        if not fresh:
            return
        former = {names.base: self._current(names) for names, _ in fresh}
        versions = [v for v in self.manifest() if v[1] != PUBLISHED or v[0] not in former]
        if archive_previous:
            versions += [(names.base, ARCHIVED, names.archive, former[names.base]) for names, _ in fresh if former[names.base]]
        versions += [(names.base, PUBLISHED, names.primary, physical) for names, physical in fresh]
        self._replace_manifest(versions)
        for names, _ in fresh:
            self.pending.pop(names.base, None)
        self.refresh_names()
        if not archive_previous:
            for name in former.values():
                if name:
                    self._drop(name)

    def refresh_names(self) -> None:
        """Views under the published and archived names, for readers that use SQL; the last of equal names counts.

        A table of that name which was there before the manifest keeps it."""
        tables = {t.name for t in self.spark.catalog.listTables(self.database) if t.tableType != "VIEW"}
        for _, _, label, physical in self.manifest():
            if label not in tables:
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(label)} AS SELECT * FROM {self.qualified(physical)}")

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")
