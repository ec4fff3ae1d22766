import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import connect, session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
