"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, differences

from replylens.plans.catalog import QUERIES
from replylens.plans.oracles import oracles

SF = "/root/testdata/sf0.001"
SQL = oracles()


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) is None

