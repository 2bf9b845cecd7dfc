import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import build_session
    s = build_session(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


def rows(df, order=None):
    """Rows as sorted tuples of Python values (columns in df order)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr)


def as_dicts(df, key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}
