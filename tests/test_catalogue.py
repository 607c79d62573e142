"""Every registered query against its SQL on the smallest tables."""

import pytest

from ledgerloom.catalogue import load_all
from tests.checker import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert difference(frame, connection, ORACLES[name]) is None
    else:
        assert frame.count() >= 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
