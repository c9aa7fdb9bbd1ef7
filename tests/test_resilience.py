"""Layer 2: resilience scoring rules over hand-made report rows."""

from pyspark.sql import functions as F

from riskweave.operators import resilience

SUPPLIER_SCHEMA = ("Supplier_ID string, total_orders bigint, avg_supplier_performance double, "
                   "avg_supplier_risk double, avg_late_delivery_risk double, avg_delivery_delay double, "
                   "total_sales double")


def test_supplier_scores(spark):
    rows = [("A", 1, 0.0, 0.0, 0.0, -5.0, 0.0),        # negative delay ignored -> 0
            ("B", 1, 0.0, 12.5, 0.0, 0.0, 0.0),        # 25 -> MEDIUM
            ("C", 1, 0.0, 24.99, 0.0, 0.0, 0.0),       # 49.98 -> MEDIUM
            ("D", 1, 0.0, 37.5, 0.0, 0.0, 0.0),        # 75 -> CRITICAL
            ("E", 1, 0.0, 60.0, 1.0, 10.0, 0.0),       # 170 clamped -> 100
            ("F", 1, 0.0, None, 1.0, 10.0, 0.0)]       # NULL addend -> 0 (greatest skips NULL)
    df = resilience.supplier_scores(spark.createDataFrame(rows, SUPPLIER_SCHEMA))
    out = {r["Supplier_ID"]: (r["supplier_risk_score"], r["supplier_risk_level"]) for r in df.collect()}
    assert out == {"A": (0.0, "LOW"), "B": (25.0, "MEDIUM"), "C": (49.98, "MEDIUM"),
                   "D": (75.0, "CRITICAL"), "E": (100.0, "CRITICAL"), "F": (0.0, "LOW")}


def test_warehouse_scores(spark):
    rows = [("W1", "High", "Under Maintenance"), ("W2", "Critical", "Active"),
            ("W3", "medium ", " INACTIVE "), ("W4", "Low", None), ("W5", None, "Active")]
    df = spark.createDataFrame(rows, "Warehouse_ID string, inventory_risk string, Warehouse_Status string")
    out = {r["Warehouse_ID"]: (r["warehouse_risk_score"], r["warehouse_risk_level"])
           for r in resilience.warehouse_scores(df).collect()}
    assert out["W1"] == (75.0, "CRITICAL")    # 52.5 + 22.5 exactly 75 in double
    assert out["W2"] == (70.0, "CRITICAL")    # critical inventory overrides
    assert out["W3"] == (57.5, "HIGH")
    assert out["W4"] == (17.5, "LOW")
    assert out["W5"] == (17.5, "LOW")


def test_route_scores(spark):
    rows = [("R1", "High", 40.0, 1.0), ("R2", "HIGH", -5.0, 0.0), ("R3", None, 41.0, None),
            ("R4", "Medium", 10.0, 0.5)]
    df = spark.createDataFrame(rows, "Route_ID string, Route_Risk_Level string, avg_delivery_delay double, "
                                     "avg_late_delivery_risk double")
    out = {r["Route_ID"]: r for r in resilience.route_scores(df).collect()}
    assert (out["R1"]["route_risk_score"], out["R1"]["route_risk_category"]) == (100.0, "CRITICAL")
    assert (out["R2"]["route_level_score"], out["R2"]["delay_score"]) == (20.0, 0.0)
    assert (out["R3"]["delay_score"], out["R3"]["late_delivery_score"]) == (100.0, 0.0)
    assert out["R4"]["route_risk_score"] == 46.5 and out["R4"]["route_risk_category"] == "MEDIUM"


def test_delivery_risk(spark):
    schema = "delivery_status string, total_shipments bigint"
    df = spark.createDataFrame([("LATE delivery ", 3), ("On time", 1), (None, 4)], schema)
    r = resilience.delivery_risk(df).collect()[0]
    assert (r["late_delivery_percentage"], r["on_time_delivery_percentage"]) == (37.5, 62.5)
    assert r["delivery_risk_level"] == "MEDIUM"
    empty = resilience.delivery_risk(spark.createDataFrame([], schema)).collect()[0]
    assert tuple(empty) == (0.0, 100.0, 0.0, "LOW")


def test_overall_risk_fallback_and_column(spark):
    delivery = resilience.delivery_risk(spark.createDataFrame([("Late", 3), ("x", 1)],
                                                              "delivery_status string, total_shipments bigint"))
    no_col = spark.createDataFrame([("High", 1)], "Route_Risk_Level string, total_records bigint")
    assert resilience.overall_risk_score(no_col, delivery).collect()[0]["overall_risk_score"] == 75.0
    with_col = spark.createDataFrame([(10.0,), (30.0,)], "Overall_Risk_Score double")
    r = resilience.overall_risk_score(with_col, delivery).collect()[0]
    assert (r["overall_risk_score"], r["overall_risk_level"]) == (20.0, "LOW")


def test_network_risk_critical_node_and_resilience(spark):
    deg = spark.createDataFrame([("A", "1", 4), ("B", "2", 2), ("C", "3", 1)],
                                "node_type string, node_id string, degree bigint")
    pr = spark.createDataFrame([("A", "1", 2.0), ("B", "2", 1.0)],
                               "node_type string, node_id string, pagerank double")
    net = resilience.network_risk(deg, pr)
    out = {r["node_id"]: r for r in net.collect()}
    assert out["1"]["network_criticality_score"] == 100.0
    assert out["2"]["network_criticality_score"] == 50.0
    assert out["3"]["network_criticality_score"] is None and out["3"]["network_risk_level"] == "LOW"
    crit = resilience.critical_node(net).collect()[0]
    assert tuple(crit) == ("1", "A", 100.0)
    res = resilience.network_resilience(net).collect()[0]
    assert (res["average_network_criticality"], res["graphx_resilience_score"]) == (75.0, 25.0)
    assert res["graphx_resilience_level"] == "LOW RESILIENCE"
    empty = resilience.critical_node(net.where(F.lit(False))).collect()[0]
    assert tuple(empty) == ("UNKNOWN", "UNKNOWN", 0.0)
