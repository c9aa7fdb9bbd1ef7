"""Layer 1: every registered query equals its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry
from conftest import SF01
from riskweave.plans import catalog
from riskweave.plans.verify import compare, duckdb_connection

KEYS = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, key, SF01, con)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
    assert res["types_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "supplier_risk_level" in df.columns
