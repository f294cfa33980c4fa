import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lendlens.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck_smoke():
    from tests.oracle_harness import duck
    return duck(SMOKE_DIR)
