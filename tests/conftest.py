import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vaultspark.session import get_session

    return get_session(master="local[8]", shuffle_partitions=8)


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
