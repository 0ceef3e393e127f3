"""The chain from files to standings, cut off and started again."""

import pytest
from pyspark.sql import functions as F

from seedline.fixtures import Fixtures
from seedline.plans import season, standings
from seedline.suite import composites

STAGES = ["dim_races", "stg_results", "dim_results", "dim_registrations", "athlete_penalties", "ext_results", "points_contributing", "ext_registrations"]


def test_a_run_goes_on_after_its_last_whole_stage(spark, tmp_path, monkeypatch):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    given = composites.season_inputs(fx)
    broken = season.StagedRun(spark, str(tmp_path / "run"))
    with monkeypatch.context() as patch:
        patch.setattr(season, "ext_results", lambda *a: fx.point_series.select(F.raise_error(F.lit("lost")).alias("x")))
        with pytest.raises(Exception, match="lost"):
            season.files_to_standings(broken, given)
    assert {r["table_name"] for r in broken.metrics().collect()} == set(STAGES[:5])
    before = {p: p.stat().st_mtime_ns for name in STAGES[:5] for p in (tmp_path / "run" / name).rglob("*.parquet")}

    def never(*args):
        raise AssertionError("files are read again")

    monkeypatch.setattr(season.staging, "staged_results", never)
    resumed = season.StagedRun(spark, str(tmp_path / "run"))
    table = season.files_to_standings(resumed, given)
    assert before == {p: p.stat().st_mtime_ns for name in STAGES[:5] for p in (tmp_path / "run" / name).rglob("*.parquet")}
    counts = {r["table_name"]: r["row_count"] for r in resumed.metrics().collect()}
    assert set(counts) == set(STAGES) and resumed.metrics().count() == len(STAGES)
    assert counts["ext_registrations"] == table.count() > 0 and counts["stg_results"] > counts["dim_races"]

    parts = {name: spark.read.parquet(str(tmp_path / "run" / name)) for name in STAGES}
    whole = standings.season_standings(
        given.point_series, parts["athlete_penalties"], parts["dim_results"], parts["dim_races"], parts["dim_registrations"]
    )
    assert sorted(map(str, whole.collect())) == sorted(map(str, table.collect()))
