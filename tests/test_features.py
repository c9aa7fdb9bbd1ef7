"""Layer 2: boundary rows for the row-level features (C1–C11) and cleaning (B)."""

from pyspark.sql import Row

from riskweave.operators import clean, features
from riskweave.sources.fact import FACT_COLUMNS, FACT_SCHEMA


def fact_rows(spark, rows):
    full = [tuple(r.get(c) for c in FACT_COLUMNS) for r in rows]
    return spark.createDataFrame(full, FACT_SCHEMA)


def by_id(df, col):
    return {r["order_id"]: r[col] for r in df.collect()}


def test_delivery_bands_and_null(spark):
    delays = [None, -1, 0, 1, 3, 4, 7, 8]
    df = features.add_risk_features(fact_rows(spark, [
        {"order_id": i, "delivery_delay_days": d} for i, d in enumerate(delays)]))
    perf, risk = by_id(df, "Delivery_Performance"), by_id(df, "Delivery_Risk_Score")
    assert [perf[i] for i in range(8)] == ["Severe Delay", "On Time", "On Time", "Slight Delay",
                                           "Slight Delay", "Moderate Delay", "Moderate Delay",
                                           "Severe Delay"]
    assert [risk[i] for i in range(8)] == [100, 0, 0, 25, 25, 60, 60, 100]


def test_inventory_bands_and_capacity_guard(spark):
    inv = [99, 100, 125, 150, 151, None]
    cap = [None, 0, 1, 200, 1000, 1000]
    df = features.add_risk_features(fact_rows(spark, [
        {"order_id": i, "Current_Inventory": v, "Safety_Stock": 100, "Warehouse_Capacity": c}
        for i, (v, c) in enumerate(zip(inv, cap))]))
    status, score = by_id(df, "Inventory_Status"), by_id(df, "Inventory_Risk_Score")
    util = by_id(df, "Warehouse_Utilization")
    assert [status[i] for i in range(6)] == ["Below Safety Stock", "Low Inventory", "Low Inventory",
                                             "Low Inventory", "Healthy Inventory", "Healthy Inventory"]
    assert [score[i] for i in range(6)] == [100, 60, 60, 60, 20, 20]
    # NULL or zero capacity divides by 1; NULL inventory gives NULL.
    assert [util[i] for i in range(6)] == [9900.0, 10000.0, 12500.0, 75.0, 15.1, None]


def test_dc_capacity_bands(spark):
    loads = [49, 50, 75, 90, None]
    df = features.add_risk_features(fact_rows(spark, [
        {"order_id": i, "Current_Load": v, "DC_Capacity": 100} for i, v in enumerate(loads)]))
    risk = by_id(df, "DC_Capacity_Risk")
    assert [risk[i] for i in range(5)] == ["Low", "Medium", "High", "Critical", "Low"]


def test_route_supplier_and_overall(spark):
    rows = [
        {"order_id": 0, "Route_Risk_Level": "High", "Supplier_Risk_Score": 70.0,
         "delivery_delay_days": 8, "Current_Inventory": 1, "Safety_Stock": 10,
         "Current_Load": 95, "DC_Capacity": 100},
        {"order_id": 1, "Route_Risk_Level": "HIGH", "Supplier_Risk_Score": 19.99},
        {"order_id": 2, "Route_Risk_Level": None, "Supplier_Risk_Score": None},
        {"order_id": 3, "Route_Risk_Level": "Low", "Supplier_Risk_Score": 20.0},
        {"order_id": 4, "Route_Risk_Level": "Medium", "Supplier_Risk_Score": 40.0},
    ]
    df = features.add_risk_features(fact_rows(spark, rows))
    route, cat = by_id(df, "Route_Risk_Score"), by_id(df, "Supplier_Risk_Category")
    overall, ocat = by_id(df, "Overall_Risk_Score"), by_id(df, "Overall_Risk_Category")
    assert [route[i] for i in range(5)] == [100, 0, 0, 20, 60]
    assert [cat[i] for i in range(5)] == ["Critical", "Low", "Low", "Medium", "High"]
    # 0.30*100 + 0.25*100 + 0.20*70 + 0.15*100 + 0.10*100 (the weight applies to the whole DC term)
    assert overall[0] == 94.0 and ocat[0] == "Critical"
    assert overall[2] is None and ocat[2] == "Low"


def test_clean_drops_all_null_rows_and_trims(spark):
    df = fact_rows(spark, [{}, {"Warehouse_Status": "  "}, {"order_id": 1, "Warehouse_Status": " inactive "}])
    out = clean.clean_fact(df).collect()
    assert len(out) == 2
    assert sorted(r["Warehouse_Status"] for r in out) == ["", "inactive"]


def test_missing_profile_counts_blank_strings(spark):
    df = fact_rows(spark, [{"order_id": 1, "Warehouse_Status": "  "}, {"order_id": None, "DC_ID": "DC1"}])
    row = clean.missing_profile(df).collect()[0]
    assert row["order_id"] == 1
    assert row["Warehouse_Status"] == 2   # one blank, one NULL
    assert row["DC_ID"] == 1
    assert len(row) == len(FACT_COLUMNS)


def test_dataset_summary(spark):
    df = fact_rows(spark, [{"order_id": 1}, {"order_id": 2}])
    assert clean.dataset_summary(df).collect()[0] == Row(row_count=2, column_count=len(FACT_COLUMNS))
