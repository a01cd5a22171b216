import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("FLEETYARD_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("FLEETYARD_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from fleetyard.session import build_session
    s = build_session("local[8]", app="fleetyard-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def small_src(spark):
    from fleetyard.sources.testdata import TestdataTables
    return TestdataTables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck_small():
    from duck_oracle.compare import connect
    return connect(SF_SMALL)
