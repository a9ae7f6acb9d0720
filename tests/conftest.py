from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from daybook import session

    s = session.build(
        "daybook-tests",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.session.timeZone": "UTC",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "1000",
        },
        master="local[4]",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001() -> str:
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def sf0001() -> str:
    return str(TESTDATA / "sf0.001")
