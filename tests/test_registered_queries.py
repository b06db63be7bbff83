"""Every registered query against its SQL twin, over whole tables."""

import pytest
from comparing import compare, oracle
from conftest import SMALL

import __spark_entry__ as entry

SQL = entry.core_oracle_sql()


@pytest.fixture(scope="module")
def database():
    return oracle(SMALL)


def test_every_query_has_a_twin():
    assert set(entry.core_queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    assert compare(spark, database, SMALL, entry.core_queries()[name], SQL[name]) is None


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert {row["status_code"] for row in rows} == {
        "pending_payment", "paid", "shipped", "received", "completed", "cancelled", "refunded"
    }
