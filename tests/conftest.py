import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fillwatch.session import local_session

    return local_session("8", shuffle_partitions=4)


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL
