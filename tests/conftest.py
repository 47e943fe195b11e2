from __future__ import annotations

import pytest

from tests.compare import duck
from tidemill.session import build_session, remove_work, shared_folder
from tidemill.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    remove_work(session)
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def con():
    return duck(SMALL)


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
