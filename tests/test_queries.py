"""Every query against its SQL, and shape checks of those without one."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry

from shelfcast.workload.oracle import ORACLES as PLAIN_ORACLES
from shelfcast.workload.queries import QUERIES

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_names():
    assert set(ORACLES) <= set(entry.queries())
    assert set(QUERIES) == set(PLAIN_ORACLES)


@pytest.mark.parametrize("name", sorted(PLAIN_ORACLES))
def test_same_as_sql(spark, con, sf_dir, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 3 and rows[0]["rmsle"] <= rows[1]["rmsle"] <= rows[2]["rmsle"]


