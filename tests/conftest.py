import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tests"))
sys.path.insert(0, str(ROOT))

from seedline.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4g", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def tiny_tasks(spark):
    """Make every group count as too large for one task, so that the distributed routes run."""
    spark.conf.set("seedline.rowsPerTask", "1")
    yield
    spark.conf.unset("seedline.rowsPerTask")
