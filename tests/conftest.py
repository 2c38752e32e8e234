from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from fathomgrid.session import session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    def collect(df) -> list[tuple]:
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
