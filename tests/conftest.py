import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallycheck.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (in the given column order), sorted for comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
