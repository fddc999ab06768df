"""Every catalog query against its SQL on the smallest tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_point
from logweir.plans.catalog import QUERIES
from logweir.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["window_start", "window_end", "service", "total_messages",
                          "error_messages", "error_rate_pct"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert not found
