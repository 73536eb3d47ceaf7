import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kpistar.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="kpistar-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from kpistar.oracle.check import duck_connect
    return duck_connect(SF_SMALL)
