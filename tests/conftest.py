from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickpulse.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    wh = str(tmp_path_factory.mktemp("warehouse"))
    s = get_session("local[*]", 8, app_name="clickpulse-tests",
                    extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as sorted tuples (for order-insensitive compares)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple("" if x is None else str(x) for x in r)) if order is None else out
