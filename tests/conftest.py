import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "lodestat-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows(spark):
    """Collect as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect
