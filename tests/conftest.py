"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bitextile.session import session, ship

    s = session("tests", "local[4]", spark_sql_shuffle_partitions=4, spark_driver_memory="4g", spark_ui_showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
