"""Every registered query against its oracle SQL, on the smallest data set."""

import pytest
from compare import compare, connect

from casewatch.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_oracle(spark, con, name):
    assert compare(spark, con, name, catalog.queries()[name], SQL[name], SF) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
