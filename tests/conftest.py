import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paperloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=2, memory="4g")


def rows(df, *cols):
    """Rows of a frame as sorted tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
