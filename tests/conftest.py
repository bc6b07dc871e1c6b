import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from beaconry.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("test tables not present")
    return DATA


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    return sorted(map(tuple, (df.select(*order) if order else df).collect()), key=repr)
