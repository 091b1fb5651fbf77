import pytest
from compare import SF, connect, spark_rows, sql_rows

from workload import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    want_columns, want = sql_rows(con, SQL[name])
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want
    assert rows, "a query without rows checks nothing"
