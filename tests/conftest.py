from __future__ import annotations

import tempfile

import pytest

from brookmill.session import build_session
from brookmill.sources.tables import Tables

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="brookmill-tests-")
    session = build_session(
        "local[8]",
        "tests",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.checkpoint.dir": folder, "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def middle(spark):
    return Tables(spark, MIDDLE)


@pytest.fixture
def path(spark):
    from brookmill.scratch import new_path

    return new_path(spark, "test")
