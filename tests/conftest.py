import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL, SF_MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from basketry.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1",
           "spark.driver.bindAddress": "127.0.0.1", "spark.sql.shuffle.partitions": "2",
           "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="basketry-test-")
