"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional) a
comma-separated choice of queries. Every query is computed in full and its rows are thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from seedline.session import local_session
from seedline.suite import QUERIES

HEADLINES = [
    "stg_results",
    "dim_results",
    "dim_registrations",
    "dim_athletes",
    "win_finish_place",
    "join_asof_penalty_list",
    "races_by_penalty_window",
    "results_by_penalty_window",
    "fit_2025",
    "fit_2026",
    "build_penalties",
    "ext_results",
    "points_contributing",
    "ext_registrations",
    "standings_from_fitted_penalties",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g")
    spark.read.parquet(f"{folder}/supplier.parquet").groupBy("s_nationkey").count().collect()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_wall_time", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
