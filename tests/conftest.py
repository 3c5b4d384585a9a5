"""A small local session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from dialoom.session import build_session, share_package

    session = build_session("tests", "local[4]", {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4"})
    session.sparkContext.setLogLevel("ERROR")
    share_package(session)
    yield session
    session.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA
