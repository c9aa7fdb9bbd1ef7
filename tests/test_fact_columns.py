"""Queries derive only the fact columns that they read; CSV copies are compressed."""

import math

from conftest import SF001
from riskweave.operators import clean, features, network
from riskweave.plans import catalog, context
from riskweave.sources.fact import load_fact


def test_empty_rows_go_and_nan_counts_as_null(spark):
    rows = [(None, None, None), (None, math.nan, None), (1, None, None), (None, 2.0, None), (None, None, " "), (2, math.nan, "x")]
    df = spark.createDataFrame(rows, "a int, b double, s string")
    got = clean.drop_empty_rows(df)
    want = df.na.drop(how="all")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == 4


def test_unread_columns_are_not_derived(spark):
    fact = features.add_risk_features(clean.clean_fact(load_fact(spark, SF001)))
    plan = fact.select(*network.FACT_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" in plan
    for unread in ("l_extendedprice", "l_quantity", "p_name", "p_type", "atleastnnonnulls"):
        assert unread not in plan


def test_reports_and_graph_do_not_write_the_wide_fact(spark):
    context.forget(spark, SF001)
    want = {k: sorted(map(repr, catalog.QUERIES[k](spark, SF001).collect())) for k in ("supplier_risk", "edge_criticality")}
    assert context.known(spark, SF001, "processed_fact") is None
    context.forget(spark, SF001)
    catalog.processed_fact(spark, SF001)  # now they read the table
    assert want == {k: sorted(map(repr, catalog.QUERIES[k](spark, SF001).collect())) for k in want}
    assert context.known(spark, SF001, "network_fact") is None


def test_csv_copy_is_compressed_and_needs_no_parquet_copy(spark):
    context.forget(spark, SF001)
    got = catalog.QUERIES["csv_roundtrip"](spark, SF001)
    assert all(f.endswith(".csv.gz") for f in got.inputFiles())
    assert context.known(spark, SF001, "raw_fact") is None
    assert got.exceptAll(load_fact(spark, SF001)).count() == 0
    assert got.count() == load_fact(spark, SF001).count()
