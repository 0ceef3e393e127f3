"""Registered queries against DuckDB. By default one query per area; FULL=1 runs all of them."""

import os

import pytest

from compare import compare, connect
from seedline.suite import CHECKS, QUERIES

SF = "0.001"
CHOSEN = [
    "fn_time_to_min",
    "map_replace",
    "scan_seasons",
    "publish_tables",
    "stg_results",
    "dim_results",
    "dim_registrations",
    "dim_athletes",
    "races_by_penalty_window",
    "results_by_penalty_window",
    "adjusted_residual",
    "build_penalties",
    "ext_results",
    "points_contributing",
    "ext_registrations",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("FULL") else CHOSEN)
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], CHECKS.get(name)) == ""


def test_registration():
    assert set(CHECKS) <= set(QUERIES)
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", ["ext_registrations", "win_best_non_maq", "agg_robust_mean", "results_by_penalty_window"])
def test_query_on_the_distributed_route(spark, con, tiny_tasks, name):
    assert compare(spark, con, SF, name, QUERIES[name], CHECKS[name]) == ""
