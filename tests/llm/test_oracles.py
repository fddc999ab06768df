"""Queries against their SQL on the smallest tables."""

import pytest
from compare import differences, duck

from logweir.llm.catalog import QUERIES
from logweir.llm.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert not differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name])
