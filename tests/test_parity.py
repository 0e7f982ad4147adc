"""Every query with SQL for it, on Spark and DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.parity import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ours = queries()[name](spark, FOLDER).toPandas()
    assert difference(ours, con.execute(oracle_sql()[name]).df()) is None


def test_flagship(spark):
    assert entry(spark).columns == ["state", "customers", "churned", "churn_rate"]
