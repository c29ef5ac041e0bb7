"""Every catalogue query against its DuckDB oracle (sf0.001; the driver checks sf0.01)."""

import pytest

import __spark_entry__ as entry
from orderlake import catalog, oracle_sql
from tests.conftest import SF_SMALL
from tests.harness import compare, duck

QUERIES = catalog.queries()
SQL = oracle_sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_registers_the_whole_catalogue():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), SQL[name], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region_name", "total_orders", "total_revenue", "avg_profit_margin"]
    assert df.count() == 5
