import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tenderlake.storage import tuned  # noqa: E402
from workload.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = tuned(local_session(8, "6g"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


def rows(df, *columns):
    """Sorted tuples of a small result."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
