import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Oracle tests run at this scale; the driver's gate uses sf0.01.
TEST_SF = os.environ.get("BLOTTER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from blotter.session import get_spark
    s = get_spark("local[*]", app_name="blotter-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_SF
