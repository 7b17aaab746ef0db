import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from popledger import get_session

    folder = str(tmp_path_factory.mktemp("checkpoint"))
    session = get_session(
        "popledger-tests", master="local[4]", shuffle_partitions=4,
        extra={"spark.driver.memory": "6g", "spark.checkpoint.dir": folder, "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables not present")
    return SMALL


@pytest.fixture(scope="session")
def model(spark, small):
    from popledger.sources.star import StarModel

    return StarModel(spark, small)


@pytest.fixture(scope="session")
def report(model):
    from popledger.plans.report import Report

    return Report(model, staged=True)
