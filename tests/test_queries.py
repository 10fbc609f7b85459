"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from checks.oracle import all_sql
from checks.compare import connect, differences
from checks.queries import all_queries

QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    assert differences(QUERIES[name](spark, sf_dir), oracle, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_is_the_snapshot(spark):
    snapshot = entry_points.entry(spark)
    assert snapshot.columns[:7] == [
        "customer_id", "first_name", "last_name", "email", "gender", "status", "signup_date",
    ]
    assert snapshot.count() == 145
