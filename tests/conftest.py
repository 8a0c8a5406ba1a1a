import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="martkit-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="martkit-warehouse-")})
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="martkit-test-")


def rows(df, order=None):
    """Collect as sorted list of tuples (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
