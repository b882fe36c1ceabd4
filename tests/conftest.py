import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.session import build_session

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


@pytest.fixture(scope="session")
def transactions(spark, data_dir):
    from riskweave.sources import transactions as tx
    return tx.transactions(spark, data_dir).cache()


@pytest.fixture(scope="session")
def scores(spark, data_dir):
    from riskweave.sources import transactions as tx
    return tx.scores(spark, data_dir).cache()
