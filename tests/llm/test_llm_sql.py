"""Registered queries against their SQL."""

import pytest
from compare import connect, differences

from replylens.llm.queries import QUERIES
from replylens.llm.sql import ORACLES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None
