"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from tallow.plans import catalog
from tallow.plans.verify import compare, duckdb_views

from conftest import SF_SMALL

# The queries of the optional subpackage are tested beside it.
QUERIES = {name: E.queries()[name] for name in catalog.QUERIES}
ORACLE = {name: E.oracle_sql()[name] for name in catalog.ORACLE}


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["values_match"], (r["only_spark"], r["only_oracle"])
    assert r["spark_rows"] == r["oracle_rows"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["exchange", "symbol", "interval_start", "interval_end", "open", "high", "low",
                          "close", "volume", "quote_volume", "trade_count", "source", "ingestion_ts"]
