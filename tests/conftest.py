import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from layerworks.session import get_session

    session = get_session(
        "layerworks-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.sql.shuffle.partitions": "8"},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="layerworks-test-")


def rows(df, *cols):
    """Sorted plain tuples of a DataFrame (optionally a column subset)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
