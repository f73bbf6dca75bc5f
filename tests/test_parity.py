"""Every registered query against its independent SQL, on the smallest test data."""

import pytest

import __spark_entry__ as entry_module
from feeloom.plans.oracle import ORACLE_SQL
from feeloom.plans.queries import QUERIES
from tests.parity import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry_module.queries()) >= set(QUERIES) and set(entry_module.queries()) >= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_entry_returns_ten_advisers(spark):
    result = entry_module.entry(spark)
    assert result.count() == 10
    assert "rank_by_ltv_6_month" in result.columns
