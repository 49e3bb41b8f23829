import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lodeworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("lodeworks-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def frame(spark):
    """Small literal frames: ``frame("a string, b int", ("x", 1), ...)``."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
