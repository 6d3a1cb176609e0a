import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from racelake.session import local_session
    s = local_session("*", shuffle_partitions=8, app="racelake-tests")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as sorted tuples (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
