"""Every query with an SQL form against DuckDB, the others for rows, on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_oracle(spark, con, name):
    assert differences(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_has_rows(spark, name):
    assert not entry.queries()[name](spark, FOLDER).isEmpty()


def test_entry(spark):
    assert entry.entry(spark).columns == ["contract", "tenure_group", "n", "churned", "churn_rate"]
