"""Layer 2: report boundary rules."""

from riskweave.operators import reports
from test_features import fact_rows


def test_warehouse_report_bands(spark):
    rows = [dict(Warehouse_ID=f"W{i}", Current_Inventory=v, Safety_Stock=100, Warehouse_Capacity=c)
            for i, (v, c) in enumerate([(99, 200), (124, 200), (125, 0), (149, None), (150, 300)])]
    out = {r["Warehouse_ID"]: r for r in reports.warehouse_inventory(fact_rows(spark, rows)).collect()}
    assert [out[f"W{i}"]["inventory_risk"] for i in range(5)] == ["Critical", "High", "Medium", "Medium", "Low"]
    assert out["W0"]["inventory_utilization"] == 49.5
    assert out["W2"]["inventory_utilization"] is None    # NULLIF(0)
    assert out["W3"]["inventory_utilization"] is None    # NULL capacity
    assert out["W4"]["inventory_utilization"] == 50.0


def test_dc_report_bands(spark):
    rows = [dict(DC_ID=f"D{i}", Current_Load=v, DC_Capacity=c)
            for i, (v, c) in enumerate([(100, 100), (85, 100), (70, 100), (69, 100), (5, 0), (5, None)])]
    out = {r["DC_ID"]: r for r in reports.distribution_center_load(fact_rows(spark, rows)).collect()}
    assert [out[f"D{i}"]["load_risk"] for i in range(6)] == ["Critical", "High", "Medium", "Low",
                                                             "Critical", "Low"]
    assert out["D4"]["dc_utilization"] is None


def test_delivery_share_sums_to_100(spark):
    rows = [dict(delivery_status=s) for s in ["a", "a", "b", None, None, None, "c"]]
    out = reports.delivery_performance(fact_rows(spark, rows)).collect()
    assert abs(sum(r["percentage"] for r in out) - 100.0) < 0.05
    assert {r["delivery_status"]: r["total_shipments"] for r in out}[None] == 3


def test_high_risk_three_valued_or(spark):
    rows = [dict(order_id=1, Supplier_Risk_Score=None, late_delivery_risk=None, Severity="High"),
            dict(order_id=2, Supplier_Risk_Score=None, late_delivery_risk=None),
            dict(order_id=3, Supplier_Risk_Score=19.0, late_delivery_risk=0, Route_Risk_Level="High"),
            dict(order_id=4, Supplier_Risk_Score=20.0, late_delivery_risk=0)]
    out = [r["order_id"] for r in reports.high_risk_records(fact_rows(spark, rows)).collect()]
    assert out == [4, 3, 1]


def test_overall_kpi_distincts_ignore_null(spark):
    rows = [dict(order_id=1, Supplier_ID="S1", sales=1.005), dict(order_id=1, Supplier_ID=None, sales=1.0),
            dict(order_id=2, Supplier_ID="S2", sales=None)]
    r = reports.overall_kpi(fact_rows(spark, rows)).collect()[0]
    assert (r["total_records"], r["total_orders"], r["total_suppliers"]) == (3, 2, 2)
    assert r["total_sales"] == 2.01
