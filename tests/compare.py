"""Run registered queries in Spark and their checks in DuckDB and compare all values.

    python tests/compare.py [name ...]      # at sf0.01, or $SF
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/sf{sf}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19]
    return value


def as_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr(tuple(plain(r[i]) for i in order)) for r in rows))


def compare(spark, con, sf: str, name: str, build, check: str | None) -> str:
    """Empty when equal, else what differs."""
    df = build(spark, f"{DATA}/sf{sf}")
    mine, columns = df.collect(), df.columns
    if check is None:
        return "" if mine else "no rows"
    cursor = con.execute(check)
    wanted_columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(wanted_columns):
        return f"columns {sorted(set(columns) ^ set(wanted_columns))}"
    theirs = cursor.fetchall()
    a, b = as_rows(mine, columns), as_rows(theirs, wanted_columns)
    if a == b:
        return "" if a else "no rows on either side"
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"{len(a)} vs {len(b)} rows, {len(only_a)} differ\n  {sorted(columns)}\n  spark {only_a[:2]}\n  check {only_b[:2]}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from seedline.session import local_session

    sf = os.environ.get("SF", "0.01")
    spark, con = local_session(), connect(sf)
    found, checks = queries(), oracle_sql()
    names = sys.argv[1:] or list(found)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf, name, found[name], checks.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(problem)
        kind = "value" if name in checks else "rows "
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
