import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from gotera.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def consumption(spark, sf_dir):
    from gotera.sources import fixtures

    return fixtures.consumption(spark, sf_dir).cache()


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    from gotera.sources import fixtures

    return fixtures.inspections(spark, sf_dir).cache()
