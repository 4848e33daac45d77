"""Every registered query equals its DuckDB oracle (names, types, rows, exact values) on sf0.001."""

import pytest

import __spark_entry__ as entry
from mercata.plans.registry import queries
from oracle_harness import compare, duck_connection

SF = "/root/testdata/sf0.001"
KEYS = sorted(queries())  # queries of the optional subpackage are tested beside it


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) and set(KEYS) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, entry.queries()[key], entry.oracle_sql()[key], SF)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["year", "month", "month_name"]
