"""Queries that SQL can express equal their SQL: names, types, rows, values."""

import pytest
from oracle_harness import compare, duck_connection

from mercata.llm import registry


@pytest.fixture(scope="module")
def con(sf):
    return duck_connection(sf)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, con, name):
    res = compare(spark, con, registry.queries()[name], registry.oracle_sql()[name], sf)
    assert res["ok"], res
