import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from casewatch.session import local_session

    session = local_session(8, shuffle_partitions=4, memory="8g", app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL
