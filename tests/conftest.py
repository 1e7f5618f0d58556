import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiocast.session import build_session  # noqa: E402
from regiocast.sources import Tables  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SF)
