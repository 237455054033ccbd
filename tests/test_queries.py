"""Every registered query against its check SQL, on the smallest tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.check_queries import check_engine, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_engine(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    found = differences(df, con, sql) if sql else None
    assert found is None, found
