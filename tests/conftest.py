import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ordersentry.session import get_session
    os.environ.setdefault("SPARK_DRIVER_MEMORY", "8g")
    s = get_session(app="ordersentry-tests", master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()
