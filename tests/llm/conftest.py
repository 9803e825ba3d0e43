import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from driftwood.session import local_session, ship_package
    s = local_session("*", shuffle_partitions=8)
    ship_package(s)
    return s


@pytest.fixture
def rng():
    return random.Random(7)
