"""Independent DuckDB oracle SQL for every registered query.

Written by hand as plain SQL over the driver's tables (pre-registered views),
not generated from the Spark operators, so it is a second implementation of
each rule. Conventions that make the two engines agree bit for bit:

* ``R(x, d)`` reproduces Spark's ``round`` on a DOUBLE: Spark rounds the
  shortest decimal representation of the double HALF_UP, so the oracle casts the
  double to text, then to an exact DECIMAL, and rounds that.
* Shares and utilisations that Spark computes in exact DECIMAL arithmetic are
  rounded exactly with integer arithmetic (``HALF_UP`` of a non-negative ratio).
* Unrounded doubles (PageRank, normalised scores, percentages of edges, ...)
  are rounded to 6 decimals on both sides in the registered query only.
* Every ORDER BY that feeds a LIMIT spells out NULLS LAST and full tie-breakers.
"""

from __future__ import annotations


def R(expr: str, digits: int) -> str:
    return (f"CAST(ROUND(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), "
            f"{digits}) AS DOUBLE)")


def R6(expr: str) -> str:
    return R(expr, 6)


def pct2(num: str, den: str) -> str:
    """round(num * 100 / den, 2) HALF_UP for non-negative integers, NULL if den is 0."""
    return (f"(CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(((20000 * ({num}) + ({den})) // (2 * ({den}))) AS DOUBLE) / 100 END)")


_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}
_RECURSIVE: set[str] = set()


def cte(name: str, sql: str, *deps: str, recursive: bool = False) -> None:
    _CTES[name] = (sql, deps)
    if recursive:
        _RECURSIVE.add(name)


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in _CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def q(body: str, *deps: str) -> str:
    """Query text: the dependency closure of ``deps`` as CTEs, then ``body``."""
    names = _closure(deps)
    if not names:
        return body
    parts = [f"{n} AS (\n{_CTES[n][0]}\n)" for n in names]
    head = "WITH RECURSIVE " if _RECURSIVE.intersection(names) else "WITH "
    return head + ",\n".join(parts) + "\n" + body


# --------------------------------------------------------------------------
# Fact table (FIXTURES.md §2), cleaned (trim) and with row-level features.
# --------------------------------------------------------------------------

cte("sc_keys", """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
       l.l_extendedprice, l.l_discount, o.o_orderkey, o.o_custkey, p.p_name, p.p_type,
       c.c_nationkey, n.n_name, r.r_name,
       l.l_orderkey * 7 + l.l_linenumber AS k,
       l.l_suppkey % 4 AS cl,
       (l.l_suppkey % 10 + l.l_partkey % 3) % 10 AS slot
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("sc_keys2", """
SELECT *, cl * 10 + slot AS wk, cl * 4 + (slot + c_nationkey % 2) % 4 AS dk
FROM sc_keys""", "sc_keys")

cte("sc_keys3", """
SELECT *, wk * 25 + c_nationkey AS rk,
       CASE WHEN k % 53 = 0 THEN NULL
            ELSE (l_orderkey * 13 + l_partkey + l_linenumber * 5) % 12 - 4 + l_suppkey % 5
                 + CASE WHEN l_suppkey % 10 = 3 THEN 12 ELSE 0 END END AS delay,
       CAST((l_suppkey * 37 + k % 7) % 101 AS DOUBLE) AS risk
FROM sc_keys2""", "sc_keys2")

cte("raw_fact", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, p_name AS product_name,
       p_type AS category_name, r_name AS order_region, l_extendedprice AS sales,
       l_extendedprice * (CAST(0.06 AS DOUBLE) - l_discount) AS order_profit_per_order,
       CAST(l_quantity AS INTEGER) AS order_item_quantity,
       delay AS delivery_delay_days,
       CASE WHEN delay > 0 THEN 1 ELSE 0 END AS late_delivery_risk,
       CASE WHEN k % 41 = 0 THEN 'Shipping canceled' WHEN delay > 0 THEN 'Late delivery'
            WHEN delay = 0 THEN 'Shipping on time' ELSE 'Advance shipping' END AS delivery_status,
       CASE WHEN k % 97 <> 0 THEN 'S' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') END AS Supplier_ID,
       CAST(100.0 AS DOUBLE) - risk AS Supplier_Performance_Score,
       risk AS Supplier_Risk_Score,
       CASE WHEN k % 89 <> 0 THEN 'W' || lpad(CAST(wk AS VARCHAR), 3, '0') END AS Warehouse_ID,
       'Warehouse ' || CAST(wk AS VARCHAR) AS Warehouse_Name,
       'City ' || CAST(wk % 11 AS VARCHAR) AS Warehouse_City,
       CASE WHEN wk % 13 = 0 THEN 0 ELSE 1000 + wk * 50 END AS Warehouse_Capacity,
       (20 + wk) * CASE wk % 5 WHEN 0 THEN 9 WHEN 1 THEN 12 WHEN 2 THEN 14 WHEN 3 THEN 15
                               ELSE 20 END AS Current_Inventory,
       (20 + wk) * 10 AS Safety_Stock,
       CASE WHEN wk % 4 = 1 THEN 'Under Maintenance' WHEN wk % 4 = 2 THEN ' inactive '
            ELSE 'Active' END AS Warehouse_Status,
       CASE WHEN k % 83 <> 0 THEN 'DC' || lpad(CAST(dk AS VARCHAR), 3, '0') END AS DC_ID,
       'DC ' || CAST(dk AS VARCHAR) AS DC_Name,
       'City ' || CAST(dk % 7 AS VARCHAR) AS DC_City,
       CASE WHEN dk = 0 THEN 0 ELSE (25 + dk) * 20 END AS DC_Capacity,
       (25 + dk) * CASE dk % 8 WHEN 0 THEN 8 WHEN 1 THEN 10 WHEN 2 THEN 14 WHEN 3 THEN 15
                               WHEN 4 THEN 17 WHEN 5 THEN 18 WHEN 6 THEN 20 ELSE 24 END AS Current_Load,
       CASE WHEN dk % 5 = 0 THEN 'Congested' ELSE 'Operational' END AS DC_Status,
       'R' || lpad(CAST(rk AS VARCHAR), 4, '0') AS Route_ID,
       'W' || lpad(CAST(wk AS VARCHAR), 3, '0') AS Source_Warehouse,
       CASE WHEN k % 79 <> 0 AND (dk + c_nationkey) % 4 <> 0
            THEN n_name || ' ' || CAST(cl AS VARCHAR) END AS Destination_ID,
       CAST(50 + (rk * 37) % 2000 AS DOUBLE) AS Distance_KM,
       CASE rk % 4 WHEN 0 THEN 'Road' WHEN 1 THEN 'Rail' WHEN 2 THEN 'Air' ELSE 'Sea' END AS Transport_Mode,
       CASE WHEN rk % 31 <> 0 THEN CASE rk % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END
            END AS Route_Risk_Level,
       CASE WHEN k % 10 >= 6 THEN CASE k % 10 WHEN 6 THEN 'Port Strike' WHEN 7 THEN 'Flood'
                                              WHEN 8 THEN 'Customs Hold' ELSE 'Cyber Attack' END
            END AS Event_Type,
       CASE WHEN k % 10 >= 6 THEN CASE k % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END
            END AS Severity,
       CASE WHEN k % 10 >= 6 THEN 1 + k % 21 END AS Duration_Days
FROM sc_keys3""", "sc_keys3")

_STRING_COLS = ("product_name", "category_name", "order_region", "delivery_status", "Supplier_ID",
                "Warehouse_ID", "Warehouse_Name", "Warehouse_City", "Warehouse_Status", "DC_ID",
                "DC_Name", "DC_City", "DC_Status", "Route_ID", "Source_Warehouse",
                "Destination_ID", "Transport_Mode", "Route_Risk_Level", "Event_Type", "Severity")
_OTHER_COLS = ("order_id", "customer_id", "sales", "order_profit_per_order", "order_item_quantity",
               "delivery_delay_days", "late_delivery_risk", "Supplier_Performance_Score",
               "Supplier_Risk_Score", "Warehouse_Capacity", "Current_Inventory", "Safety_Stock",
               "DC_Capacity", "Current_Load", "Distance_KM", "Duration_Days")

cte("clean_fact", "SELECT " + ", ".join(
    [f"TRIM({c}) AS {c}" for c in _STRING_COLS] + list(_OTHER_COLS))
    + "\nFROM raw_fact WHERE NOT (" + " AND ".join(
        f"{c} IS NULL" for c in _STRING_COLS + _OTHER_COLS) + ")", "raw_fact")

cte("sc_feat1", f"""
SELECT *,
  CASE WHEN delivery_delay_days <= 0 THEN 'On Time' WHEN delivery_delay_days <= 3 THEN 'Slight Delay'
       WHEN delivery_delay_days <= 7 THEN 'Moderate Delay' ELSE 'Severe Delay' END AS Delivery_Performance,
  CASE WHEN delivery_delay_days <= 0 THEN 0 WHEN delivery_delay_days <= 3 THEN 25
       WHEN delivery_delay_days <= 7 THEN 60 ELSE 100 END AS Delivery_Risk_Score,
  {R("Current_Inventory / (CASE WHEN Warehouse_Capacity > 0 THEN Warehouse_Capacity ELSE 1 END) * 100", 2)}
    AS Warehouse_Utilization,
  CASE WHEN Current_Inventory < Safety_Stock THEN 'Below Safety Stock'
       WHEN Current_Inventory <= Safety_Stock * CAST(1.5 AS DOUBLE) THEN 'Low Inventory'
       ELSE 'Healthy Inventory' END AS Inventory_Status,
  CASE WHEN Current_Inventory < Safety_Stock THEN 100
       WHEN Current_Inventory <= Safety_Stock * CAST(1.5 AS DOUBLE) THEN 60 ELSE 20 END AS Inventory_Risk_Score,
  {R("Current_Load / (CASE WHEN DC_Capacity > 0 THEN DC_Capacity ELSE 1 END) * 100", 2)} AS DC_Utilization,
  CASE WHEN Route_Risk_Level = 'High' THEN 100 WHEN Route_Risk_Level = 'Medium' THEN 60
       WHEN Route_Risk_Level = 'Low' THEN 20 ELSE 0 END AS Route_Risk_Score,
  CASE WHEN Supplier_Risk_Score >= 70 THEN 'Critical' WHEN Supplier_Risk_Score >= 40 THEN 'High'
       WHEN Supplier_Risk_Score >= 20 THEN 'Medium' ELSE 'Low' END AS Supplier_Risk_Category
FROM clean_fact""", "clean_fact")

cte("sc_feat2", """
SELECT *, CASE WHEN DC_Utilization >= 90 THEN 'Critical' WHEN DC_Utilization >= 75 THEN 'High'
               WHEN DC_Utilization >= 50 THEN 'Medium' ELSE 'Low' END AS DC_Capacity_Risk
FROM sc_feat1""", "sc_feat1")

cte("sc_feat3", f"""
SELECT *, {R('''Delivery_Risk_Score * CAST(0.30 AS DOUBLE) + Inventory_Risk_Score * CAST(0.25 AS DOUBLE)
        + Supplier_Risk_Score * CAST(0.20 AS DOUBLE) + Route_Risk_Score * CAST(0.15 AS DOUBLE)
        + (CASE WHEN DC_Capacity_Risk = 'Critical' THEN 100 WHEN DC_Capacity_Risk = 'High' THEN 75
                WHEN DC_Capacity_Risk = 'Medium' THEN 50 ELSE 20 END) * CAST(0.10 AS DOUBLE)''', 2)}
    AS Overall_Risk_Score
FROM sc_feat2""", "sc_feat2")

cte("supply_chain", """
SELECT *, CASE WHEN Overall_Risk_Score >= 75 THEN 'Critical' WHEN Overall_Risk_Score >= 50 THEN 'High'
               WHEN Overall_Risk_Score >= 25 THEN 'Medium' ELSE 'Low' END AS Overall_Risk_Category
FROM sc_feat3""", "sc_feat3")


# --------------------------------------------------------------------------
# Reports (D)
# --------------------------------------------------------------------------

def _avg2(c: str) -> str:
    return R(f"AVG({c})", 2)


def _sum2(c: str) -> str:
    return R(f"SUM({c})", 2)


cte("d2_delivery", f"""
SELECT delivery_status, COUNT(*) AS total_shipments,
       {pct2("COUNT(*)", "SUM(COUNT(*)) OVER ()")} AS percentage
FROM supply_chain GROUP BY delivery_status""", "supply_chain")

cte("d4_supplier", f"""
SELECT Supplier_ID, COUNT(*) AS total_orders,
       {_avg2("Supplier_Performance_Score")} AS avg_supplier_performance,
       {_avg2("Supplier_Risk_Score")} AS avg_supplier_risk,
       {_avg2("late_delivery_risk")} AS avg_late_delivery_risk,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay,
       {_sum2("sales")} AS total_sales
FROM supply_chain WHERE Supplier_ID IS NOT NULL GROUP BY Supplier_ID""", "supply_chain")

cte("d6_warehouse", f"""
SELECT Warehouse_ID, Warehouse_Name, Warehouse_City, Warehouse_Capacity, Current_Inventory,
       Safety_Stock, Warehouse_Status,
       {pct2("Current_Inventory", "Warehouse_Capacity")} AS inventory_utilization,
       CASE WHEN Current_Inventory < Safety_Stock THEN 'Critical'
            WHEN Current_Inventory < Safety_Stock * 1.25 THEN 'High'
            WHEN Current_Inventory < Safety_Stock * 1.50 THEN 'Medium' ELSE 'Low' END AS inventory_risk
FROM supply_chain WHERE Warehouse_ID IS NOT NULL
GROUP BY Warehouse_ID, Warehouse_Name, Warehouse_City, Warehouse_Capacity, Current_Inventory,
         Safety_Stock, Warehouse_Status""", "supply_chain")

cte("d7_dc", f"""
SELECT DC_ID, DC_Name, DC_City, DC_Capacity, Current_Load, DC_Status,
       {pct2("Current_Load", "DC_Capacity")} AS dc_utilization,
       CASE WHEN Current_Load >= DC_Capacity THEN 'Critical'
            WHEN Current_Load >= DC_Capacity * 0.85 THEN 'High'
            WHEN Current_Load >= DC_Capacity * 0.70 THEN 'Medium' ELSE 'Low' END AS load_risk
FROM supply_chain WHERE DC_ID IS NOT NULL
GROUP BY DC_ID, DC_Name, DC_City, DC_Capacity, Current_Load, DC_Status""", "supply_chain")

cte("d8_route", f"""
SELECT Route_ID, Transport_Mode, Route_Risk_Level,
       {_avg2("Distance_KM")} AS avg_distance_km, COUNT(*) AS total_shipments,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay,
       {_avg2("late_delivery_risk")} AS avg_late_delivery_risk
FROM supply_chain WHERE Route_ID IS NOT NULL
GROUP BY Route_ID, Transport_Mode, Route_Risk_Level""", "supply_chain")

cte("d13_overall", f"""
SELECT Route_Risk_Level, Severity, COUNT(*) AS total_records,
       {_avg2("Supplier_Risk_Score")} AS avg_supplier_risk,
       {_avg2("late_delivery_risk")} AS avg_delivery_risk,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay
FROM supply_chain GROUP BY Route_Risk_Level, Severity""", "supply_chain")

_SALES = f"""COUNT(*) AS total_orders, {_sum2("sales")} AS total_sales,
       {_sum2("order_profit_per_order")} AS total_profit,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay,
       {_avg2("late_delivery_risk")} AS avg_late_delivery_risk"""


ORACLE: dict[str, str] = {}


def register(key: str, sql: str) -> None:
    ORACLE[key] = sql


_OVERALL_KPI = q(f"""
SELECT COUNT(*) AS total_records, COUNT(DISTINCT order_id) AS total_orders,
       COUNT(DISTINCT customer_id) AS total_customers, COUNT(DISTINCT product_name) AS total_products,
       COUNT(DISTINCT Supplier_ID) AS total_suppliers, COUNT(DISTINCT Warehouse_ID) AS total_warehouses,
       {_sum2("sales")} AS total_sales, {_sum2("order_profit_per_order")} AS total_profit,
       {_avg2("order_item_quantity")} AS avg_order_quantity,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay
FROM supply_chain""", "supply_chain")
register("overall_kpi", _OVERALL_KPI)
register("overall_kpi_merged", _OVERALL_KPI)

register("delivery_performance", q("SELECT * FROM d2_delivery", "d2_delivery"))

register("region_analysis", q(f"""
SELECT order_region, COUNT(*) AS total_orders, {_sum2("sales")} AS total_sales,
       {_sum2("order_profit_per_order")} AS total_profit,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay,
       {_avg2("late_delivery_risk")} AS avg_late_delivery_risk
FROM supply_chain GROUP BY order_region""", "supply_chain"))

register("supplier_risk", q("SELECT * FROM d4_supplier", "d4_supplier"))

register("top_high_risk_suppliers", q(f"""
SELECT Supplier_ID, {_avg2("Supplier_Performance_Score")} AS supplier_performance,
       {_avg2("Supplier_Risk_Score")} AS supplier_risk, COUNT(*) AS affected_orders
FROM supply_chain WHERE Supplier_ID IS NOT NULL GROUP BY Supplier_ID
ORDER BY supplier_risk DESC NULLS LAST, Supplier_ID ASC NULLS LAST LIMIT 10""", "supply_chain"))

register("warehouse_inventory", q("SELECT * FROM d6_warehouse", "d6_warehouse"))
register("distribution_center_load", q("SELECT * FROM d7_dc", "d7_dc"))
register("route_risk", q("SELECT * FROM d8_route", "d8_route"))

register("transport_mode", q(f"""
SELECT Transport_Mode, COUNT(*) AS total_shipments, {_avg2("Distance_KM")} AS avg_distance_km,
       {_avg2("delivery_delay_days")} AS avg_delivery_delay,
       {_avg2("late_delivery_risk")} AS avg_late_delivery_risk, {_sum2("sales")} AS total_sales
FROM supply_chain WHERE Transport_Mode IS NOT NULL GROUP BY Transport_Mode""", "supply_chain"))

register("product_performance", q(f"""
SELECT product_name, category_name, {_SALES}
FROM supply_chain WHERE product_name IS NOT NULL GROUP BY product_name, category_name
ORDER BY total_sales DESC NULLS LAST, product_name ASC NULLS LAST, category_name ASC NULLS LAST
LIMIT 20""", "supply_chain"))

register("category_performance", q(f"""
SELECT category_name, {_SALES}
FROM supply_chain WHERE category_name IS NOT NULL GROUP BY category_name""", "supply_chain"))

register("disruption_events", q(f"""
SELECT Event_Type, Severity, COUNT(*) AS total_events,
       {_avg2("Duration_Days")} AS avg_duration_days, MAX(Duration_Days) AS max_duration_days
FROM supply_chain WHERE Event_Type IS NOT NULL GROUP BY Event_Type, Severity""", "supply_chain"))

register("overall_risk", q("SELECT * FROM d13_overall", "d13_overall"))

register("high_risk_records", q("""
SELECT order_id, Supplier_ID, Warehouse_ID, DC_ID, Route_ID, Supplier_Risk_Score,
       late_delivery_risk, delivery_delay_days, Route_Risk_Level, Severity, Event_Type
FROM supply_chain
WHERE Supplier_Risk_Score >= 20 OR late_delivery_risk = 1 OR Route_Risk_Level = 'High'
   OR Severity = 'High'
ORDER BY Supplier_Risk_Score DESC NULLS LAST, delivery_delay_days DESC NULLS LAST,
         order_id ASC NULLS LAST, Supplier_ID ASC NULLS LAST, Warehouse_ID ASC NULLS LAST,
         DC_ID ASC NULLS LAST, Route_ID ASC NULLS LAST, late_delivery_risk ASC NULLS LAST,
         Route_Risk_Level ASC NULLS LAST, Severity ASC NULLS LAST, Event_Type ASC NULLS LAST
LIMIT 1000""", "supply_chain"))


# --------------------------------------------------------------------------
# B / C: profiling, cleaning, row-level features
# --------------------------------------------------------------------------

register("missing_profile", q("SELECT " + ",\n       ".join(
    [f"COUNT(*) FILTER (WHERE {c} IS NULL OR TRIM({c}) = '') AS {c}" for c in _STRING_COLS]
    + [f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _OTHER_COLS])
    + "\nFROM raw_fact", "raw_fact"))

register("dataset_summary", q("""
SELECT COUNT(*) AS row_count, CAST(47 AS BIGINT) AS column_count FROM supply_chain""",
                              "supply_chain"))

register("clean_fact", q("SELECT * FROM clean_fact", "clean_fact"))

_FEATURE_VIEWS = {
    "feat_delivery_performance": "order_id, delivery_delay_days, Delivery_Performance",
    "feat_delivery_risk": "order_id, delivery_delay_days, Delivery_Risk_Score",
    "feat_warehouse_utilization": "order_id, Warehouse_ID, Current_Inventory, Warehouse_Capacity, "
                                  "Warehouse_Utilization",
    "feat_inventory_status": "order_id, Warehouse_ID, Current_Inventory, Safety_Stock, Inventory_Status",
    "feat_inventory_risk": "order_id, Warehouse_ID, Current_Inventory, Safety_Stock, Inventory_Risk_Score",
    "feat_dc_utilization": "order_id, DC_ID, Current_Load, DC_Capacity, DC_Utilization",
    "feat_dc_capacity_risk": "order_id, DC_ID, DC_Utilization, DC_Capacity_Risk",
    "feat_route_risk": "order_id, Route_ID, Route_Risk_Level, Route_Risk_Score",
    "feat_supplier_category": "order_id, Supplier_ID, Supplier_Risk_Score, Supplier_Risk_Category",
    "feat_overall_risk": "order_id, Supplier_ID, Delivery_Risk_Score, Inventory_Risk_Score, "
                         "Supplier_Risk_Score, Route_Risk_Score, DC_Capacity_Risk, Overall_Risk_Score",
    "feat_overall_category": "order_id, Overall_Risk_Score, Overall_Risk_Category",
}
for _k, _cols in _FEATURE_VIEWS.items():
    register(_k, q(f"SELECT {_cols} FROM supply_chain", "supply_chain"))

register("risk_preview", q("""
SELECT order_id, Supplier_ID, Warehouse_ID, delivery_delay_days, Delivery_Performance,
       Delivery_Risk_Score, Current_Inventory, Safety_Stock, Inventory_Status, Inventory_Risk_Score,
       Warehouse_Utilization, Route_Risk_Level, Route_Risk_Score, Supplier_Risk_Score,
       Overall_Risk_Score, Overall_Risk_Category
FROM supply_chain""", "supply_chain"))


# --------------------------------------------------------------------------
# E: graph construction
# --------------------------------------------------------------------------

cte("graph_nodes", """
SELECT node_id, CASE MIN(layer) WHEN 0 THEN 'SUPPLIER' WHEN 1 THEN 'WAREHOUSE'
                                WHEN 2 THEN 'DISTRIBUTION_CENTER' ELSE 'DESTINATION' END AS node_type
FROM (SELECT Supplier_ID AS node_id, 0 AS layer FROM supply_chain WHERE Supplier_ID IS NOT NULL
      UNION ALL SELECT Warehouse_ID, 1 FROM supply_chain WHERE Warehouse_ID IS NOT NULL
      UNION ALL SELECT DC_ID, 2 FROM supply_chain WHERE DC_ID IS NOT NULL
      UNION ALL SELECT Destination_ID, 3 FROM supply_chain WHERE Destination_ID IS NOT NULL) ids
GROUP BY node_id""", "supply_chain")

cte("graph_edges", f"""
SELECT src, dst, relationship, COUNT(*) AS transaction_count, {R("AVG(d)", 2)} AS avg_delivery_delay
FROM (SELECT Supplier_ID AS src, Warehouse_ID AS dst, 'SUPPLIES' AS relationship, delivery_delay_days AS d
      FROM supply_chain WHERE Supplier_ID IS NOT NULL AND Warehouse_ID IS NOT NULL
      UNION ALL
      SELECT Warehouse_ID, DC_ID, 'SERVES', delivery_delay_days
      FROM supply_chain WHERE Warehouse_ID IS NOT NULL AND DC_ID IS NOT NULL
      UNION ALL
      SELECT DC_ID, Destination_ID, 'DISTRIBUTES_TO', delivery_delay_days
      FROM supply_chain WHERE DC_ID IS NOT NULL AND Destination_ID IS NOT NULL) e
GROUP BY src, dst, relationship""", "supply_chain")

cte("route_edges", """
SELECT DISTINCT Source_Warehouse AS src, Destination_ID AS dst, Route_ID, Distance_KM, Transport_Mode,
       Route_Risk_Level, delivery_delay_days, late_delivery_risk
FROM supply_chain
WHERE Route_ID IS NOT NULL AND Source_Warehouse IS NOT NULL AND Destination_ID IS NOT NULL""",
    "supply_chain")

cte("valid_edges", """
SELECT * FROM graph_edges
WHERE src IN (SELECT node_id FROM graph_nodes) AND dst IN (SELECT node_id FROM graph_nodes)""",
    "graph_edges", "graph_nodes")

register("graph_nodes", q("SELECT node_id, node_type FROM graph_nodes", "graph_nodes"))
register("node_type_counts", q("SELECT node_type, COUNT(*) AS node_count FROM graph_nodes GROUP BY node_type",
                               "graph_nodes"))
register("graph_edges", q("SELECT * FROM graph_edges", "graph_edges"))
register("relationship_counts", q("""
SELECT relationship, COUNT(*) AS edge_count FROM graph_edges GROUP BY relationship""", "graph_edges"))
register("route_edges", q("SELECT * FROM route_edges", "route_edges"))
register("route_network_summary", q("""
SELECT Transport_Mode, Route_Risk_Level, COUNT(*) AS connections,
       CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total_connections
FROM route_edges GROUP BY Transport_Mode, Route_Risk_Level""", "route_edges"))
register("top_connections", q("""
SELECT src, dst, relationship, transaction_count, avg_delivery_delay FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY relationship
                               ORDER BY transaction_count DESC, src, dst) AS rn
  FROM graph_edges) t
WHERE rn <= 10""", "graph_edges"))
register("graph_summary", q("""
SELECT (SELECT COUNT(*) FROM graph_nodes) AS total_nodes, (SELECT COUNT(*) FROM graph_edges) AS total_edges,
       (SELECT COUNT(*) FROM route_edges) AS total_route_edges,
       (SELECT COUNT(*) FROM valid_edges) AS valid_edges""", "graph_nodes", "graph_edges", "route_edges",
                            "valid_edges"))


# --------------------------------------------------------------------------
# F: graph analytics
# --------------------------------------------------------------------------

cte("degree", """
SELECT n.node_type, n.node_id, c.degree
FROM (SELECT node_id, COUNT(*) AS degree
      FROM (SELECT src AS node_id FROM valid_edges UNION ALL SELECT dst FROM valid_edges) ends
      GROUP BY node_id) c
JOIN graph_nodes n ON n.node_id = c.node_id""", "valid_edges", "graph_nodes")

# PageRank closed form: Jacobi rounds x' = 0.15 + 0.85 * sum(x(u) / outdeg(u)); on the
# layered (acyclic) fixture graph it is exact after depth + 1 rounds; 6 are unrolled.
cte("pr_w", """
SELECT src, dst, CAST(1.0 AS DOUBLE) / COUNT(*) OVER (PARTITION BY src) AS w FROM valid_edges""",
    "valid_edges")
cte("pr0", "SELECT node_id, CAST(0.15 AS DOUBLE) AS pr FROM graph_nodes", "graph_nodes")
for _i in range(1, 7):
    cte(f"pr{_i}", f"""
SELECT n.node_id, CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * COALESCE(s.msg, 0) AS pr
FROM graph_nodes n
LEFT JOIN (SELECT w.dst, SUM(p.pr * w.w) AS msg FROM pr_w w JOIN pr{_i - 1} p ON p.node_id = w.src
           GROUP BY w.dst) s ON s.dst = n.node_id""", "graph_nodes", "pr_w", f"pr{_i - 1}")
cte("pagerank", """
SELECT n.node_type, p.node_id, p.pr * (COUNT(*) OVER () / SUM(p.pr) OVER ()) AS pagerank
FROM pr6 p JOIN graph_nodes n ON n.node_id = p.node_id""", "pr6", "graph_nodes")

cte("cc_edges", """
SELECT src AS a, dst AS b FROM valid_edges WHERE src <> dst
UNION SELECT dst, src FROM valid_edges WHERE src <> dst""", "valid_edges")
cte("cc_reach", """
SELECT node_id, node_id AS lbl FROM graph_nodes
UNION
SELECT e.b, r.lbl FROM cc_reach r JOIN cc_edges e ON e.a = r.node_id""", "graph_nodes", "cc_edges",
    recursive=True)
cte("components", """
SELECT c.component_id, n.node_type, n.node_id
FROM (SELECT node_id, MIN(lbl) AS component_id FROM cc_reach GROUP BY node_id) c
JOIN graph_nodes n ON n.node_id = c.node_id""", "cc_reach", "graph_nodes")

cte("critical", f"""
SELECT node_type, node_id, pagerank, total_degree, degree_score, pagerank_score,
       {R("degree_score * CAST(0.40 AS DOUBLE) + pagerank_score * CAST(0.60 AS DOUBLE)", 2)}
         AS criticality_score
FROM (SELECT p.node_type, p.node_id, p.pagerank, d.degree AS total_degree,
             CASE WHEN MAX(d.degree) OVER () > 0
                  THEN CAST(d.degree AS DOUBLE) / MAX(d.degree) OVER () * CAST(100.0 AS DOUBLE)
                  ELSE CAST(0.0 AS DOUBLE) END AS degree_score,
             CASE WHEN MAX(p.pagerank) OVER () > 0
                  THEN p.pagerank / MAX(p.pagerank) OVER () * CAST(100.0 AS DOUBLE)
                  ELSE CAST(0.0 AS DOUBLE) END AS pagerank_score
      FROM pagerank p JOIN degree d ON d.node_type = p.node_type AND d.node_id = p.node_id) b""",
    "pagerank", "degree")
cte("critical_lv", """
SELECT *, CASE WHEN criticality_score >= 75 THEN 'CRITICAL' WHEN criticality_score >= 50 THEN 'HIGH'
               WHEN criticality_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS criticality_level
FROM critical""", "critical")

_CRIT_COLS = (f"node_type, node_id, {R6('pagerank')} AS pagerank, total_degree, "
              f"{R6('degree_score')} AS degree_score, {R6('pagerank_score')} AS pagerank_score, "
              "criticality_score, criticality_level")

register("valid_edges", q("SELECT * FROM valid_edges", "valid_edges"))
register("edge_criticality", q("""
SELECT src, dst, relationship, transaction_count, avg_delivery_delay FROM valid_edges""", "valid_edges"))
register("parquet_roundtrip", ORACLE["region_analysis"])
register("sql_view_report", q("""
SELECT Supplier_ID, COUNT(*) AS total_records, MAX(Supplier_Risk_Score) AS max_supplier_risk
FROM supply_chain WHERE Supplier_ID IS NOT NULL GROUP BY Supplier_ID""", "supply_chain"))
register("top_critical_edges", q("""
SELECT src, dst, relationship, transaction_count, avg_delivery_delay FROM valid_edges
ORDER BY transaction_count DESC NULLS LAST, src, dst, relationship LIMIT 20""", "valid_edges"))
register("in_degree", q("""
SELECT n.node_type, n.node_id, c.in_degree
FROM (SELECT dst AS node_id, COUNT(*) AS in_degree FROM valid_edges GROUP BY dst) c
JOIN graph_nodes n ON n.node_id = c.node_id""", "valid_edges", "graph_nodes"))
register("out_degree", q("""
SELECT n.node_type, n.node_id, c.out_degree
FROM (SELECT src AS node_id, COUNT(*) AS out_degree FROM valid_edges GROUP BY src) c
JOIN graph_nodes n ON n.node_id = c.node_id""", "valid_edges", "graph_nodes"))
register("degree", q("SELECT * FROM degree", "degree"))
register("pagerank", q(f"SELECT node_type, node_id, {R6('pagerank')} AS pagerank FROM pagerank", "pagerank"))
register("top_pagerank_by_type", q(f"""
SELECT node_type, node_id, pagerank FROM (
  SELECT node_type, node_id, {R6('pagerank')} AS pagerank,
         ROW_NUMBER() OVER (PARTITION BY node_type ORDER BY {R('pagerank', 10)} DESC NULLS LAST, node_id) AS rn
  FROM pagerank WHERE node_type IN ('SUPPLIER', 'WAREHOUSE', 'DISTRIBUTION_CENTER')) t
WHERE rn <= 20""", "pagerank"))
register("connected_components", q("SELECT * FROM components", "components"))
register("component_sizes", q("""
SELECT component_id, COUNT(*) AS node_count FROM components GROUP BY component_id""", "components"))
register("critical_nodes", q(f"SELECT {_CRIT_COLS} FROM critical_lv", "critical_lv"))
register("top_critical_by_type", q(f"""
SELECT {_CRIT_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY node_type
                               ORDER BY criticality_score DESC NULLS LAST, node_id) AS rn
  FROM critical_lv WHERE node_type IN ('SUPPLIER', 'WAREHOUSE', 'DISTRIBUTION_CENTER')) t
WHERE rn <= 20""", "critical_lv"))


def _impact(top_sql: str, score: str, deps: tuple[str, ...]) -> str:
    pct = R6("CASE WHEN total_edges > 0 THEN CAST(affected_edges AS DOUBLE) / total_edges "
             "* CAST(100.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END")
    res = R6("CASE WHEN total_edges > 0 THEN CAST(total_edges - affected_edges AS DOUBLE) / total_edges "
             "* CAST(100.0 AS DOUBLE) ELSE CAST(100.0 AS DOUBLE) END")
    res_raw = ("CASE WHEN total_edges > 0 THEN CAST(total_edges - affected_edges AS DOUBLE) / total_edges "
               "* CAST(100.0 AS DOUBLE) ELSE CAST(100.0 AS DOUBLE) END")
    return q(f"""
SELECT failed_node_id, failed_node_type, {score}, affected_edges, total_edges, {pct} AS affected_percentage,
       remaining_vertices, total_edges - affected_edges AS remaining_edges, {res} AS resilience_score,
       CASE WHEN {res_raw} >= 90 THEN 'HIGH RESILIENCE' WHEN {res_raw} >= 75 THEN 'GOOD RESILIENCE'
            WHEN {res_raw} >= 50 THEN 'MODERATE RESILIENCE' ELSE 'LOW RESILIENCE' END AS resilience_level
FROM (SELECT t.node_id AS failed_node_id, t.node_type AS failed_node_type, t.{score},
             (SELECT COUNT(*) FROM valid_edges e WHERE e.src = t.node_id OR e.dst = t.node_id) AS affected_edges,
             (SELECT COUNT(*) FROM valid_edges) AS total_edges,
             (SELECT COUNT(*) FROM graph_nodes g WHERE g.node_id <> t.node_id) AS remaining_vertices
      FROM ({top_sql}) t) x""", *deps, "valid_edges", "graph_nodes")


register("removal_impact_top", _impact("""
SELECT node_id, node_type, criticality_score FROM critical
ORDER BY criticality_score DESC NULLS LAST, node_type, node_id LIMIT 1""", "criticality_score",
                                       ("critical",)))
register("removal_impact_pagerank", _impact(f"""
SELECT node_id, node_type, {R6('pagerank')} AS pagerank FROM pagerank
ORDER BY {R('pagerank', 10)} DESC NULLS LAST, node_type, node_id LIMIT 1""", "pagerank", ("pagerank",)))

register("removal_impact_all", q(f"""
SELECT failed_node_id, failed_node_type, affected_edges, total_edges,
       {R6("CASE WHEN total_edges > 0 THEN CAST(affected_edges AS DOUBLE) / total_edges * CAST(100.0 AS DOUBLE) "
           "ELSE CAST(0.0 AS DOUBLE) END")} AS affected_percentage,
       remaining_vertices, total_edges - affected_edges AS remaining_edges,
       {R6("res")} AS resilience_score,
       CASE WHEN res >= 90 THEN 'HIGH RESILIENCE' WHEN res >= 75 THEN 'GOOD RESILIENCE'
            WHEN res >= 50 THEN 'MODERATE RESILIENCE' ELSE 'LOW RESILIENCE' END AS resilience_level
FROM (SELECT *, CASE WHEN total_edges > 0
                     THEN CAST(total_edges - affected_edges AS DOUBLE) / total_edges * CAST(100.0 AS DOUBLE)
                     ELSE CAST(100.0 AS DOUBLE) END AS res
      FROM (SELECT n.node_id AS failed_node_id, n.node_type AS failed_node_type,
                   (SELECT COUNT(*) FROM valid_edges e WHERE e.src = n.node_id OR e.dst = n.node_id)
                     AS affected_edges,
                   (SELECT COUNT(*) FROM valid_edges) AS total_edges,
                   (SELECT COUNT(*) FROM graph_nodes) - 1 AS remaining_vertices
            FROM graph_nodes n) a) b""", "valid_edges", "graph_nodes"))


# --------------------------------------------------------------------------
# G: resilience roll-up (over the rounded reports)
# --------------------------------------------------------------------------

def _level(x: str) -> str:
    return (f"CASE WHEN {x} >= 75 THEN 'CRITICAL' WHEN {x} >= 50 THEN 'HIGH' "
            f"WHEN {x} >= 25 THEN 'MEDIUM' ELSE 'LOW' END")


def _clamp(x: str) -> str:
    return f"LEAST(CAST(100.0 AS DOUBLE), GREATEST(CAST(0.0 AS DOUBLE), {x}))"


cte("g_sup0", f"""
SELECT *, {_clamp('''avg_supplier_risk * CAST(2.0 AS DOUBLE) + avg_late_delivery_risk * CAST(30.0 AS DOUBLE)
        + CASE WHEN avg_delivery_delay > 0 THEN avg_delivery_delay * CAST(2.0 AS DOUBLE)
               ELSE CAST(0.0 AS DOUBLE) END''')} AS supplier_risk_score
FROM d4_supplier""", "d4_supplier")
cte("g_sup", f"SELECT *, {_level('supplier_risk_score')} AS supplier_risk_level FROM g_sup0", "g_sup0")

cte("g_wh0", """
SELECT *,
  CAST(CASE lower(trim(inventory_risk)) WHEN 'critical' THEN 100.0 WHEN 'high' THEN 75.0
       WHEN 'medium' THEN 50.0 ELSE 25.0 END AS DOUBLE) AS inventory_risk_score,
  CAST(CASE WHEN lower(trim(Warehouse_Status)) IN ('under maintenance', 'inactive') THEN 75.0
            ELSE 0.0 END AS DOUBLE) AS status_risk_score
FROM d6_warehouse""", "d6_warehouse")
cte("g_wh1", """
SELECT *, LEAST(CAST(100.0 AS DOUBLE), inventory_risk_score * CAST(0.70 AS DOUBLE)
                + status_risk_score * CAST(0.30 AS DOUBLE)) AS warehouse_risk_score
FROM g_wh0""", "g_wh0")
cte("g_wh", f"""
SELECT *, CASE WHEN lower(trim(inventory_risk)) = 'critical' THEN 'CRITICAL'
               ELSE {_level('warehouse_risk_score')} END AS warehouse_risk_level
FROM g_wh1""", "g_wh1")

cte("g_rt0", f"""
SELECT *,
  CAST(CASE WHEN Route_Risk_Level = 'High' THEN 100.0 WHEN Route_Risk_Level = 'Medium' THEN 60.0
            ELSE 20.0 END AS DOUBLE) AS route_level_score,
  {_clamp("avg_delivery_delay * CAST(2.5 AS DOUBLE)")} AS delay_score,
  {_clamp("avg_late_delivery_risk * CAST(100.0 AS DOUBLE)")} AS late_delivery_score
FROM d8_route""", "d8_route")
cte("g_rt1", f"""
SELECT *, {R('''route_level_score * CAST(0.40 AS DOUBLE) + delay_score * CAST(0.30 AS DOUBLE)
               + late_delivery_score * CAST(0.30 AS DOUBLE)''', 3)} AS route_risk_score
FROM g_rt0""", "g_rt0")
cte("g_rt", f"SELECT *, {_level('route_risk_score')} AS route_risk_category FROM g_rt1", "g_rt1")

cte("g_del0", """
SELECT CASE WHEN total > 0 THEN late / total * CAST(100.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
         AS late_delivery_percentage
FROM (SELECT COALESCE(SUM(CASE WHEN position('late' IN lower(trim(delivery_status))) > 0
                               THEN CAST(total_shipments AS DOUBLE) END), CAST(0.0 AS DOUBLE)) AS late,
             COALESCE(SUM(CAST(total_shipments AS DOUBLE)), CAST(0.0 AS DOUBLE)) AS total
      FROM d2_delivery) s""", "d2_delivery")
cte("g_del1", f"""
SELECT late_delivery_percentage,
       CAST(100.0 AS DOUBLE) - late_delivery_percentage AS on_time_delivery_percentage,
       {_clamp('late_delivery_percentage')} AS delivery_risk_score
FROM g_del0""", "g_del0")
cte("g_del", f"SELECT *, {_level('delivery_risk_score')} AS delivery_risk_level FROM g_del1", "g_del1")

# overall_risk never has Overall_Risk_Score, so the score falls back to the delivery score.
cte("g_ovr", f"""
SELECT delivery_risk_score AS overall_risk_score, {_level('delivery_risk_score')} AS overall_risk_level
FROM g_del""", "g_del", "d13_overall")

cte("g_net0", """
SELECT d.node_type, d.node_id, d.degree, p.pagerank,
       CAST(MAX(d.degree) OVER () AS DOUBLE) AS maxd, MAX(p.pagerank) OVER () AS maxp
FROM degree d LEFT JOIN pagerank p ON p.node_type = d.node_type AND p.node_id = d.node_id""",
    "degree", "pagerank")
cte("g_net1", """
SELECT node_type, node_id, degree, pagerank,
       CASE WHEN maxd > 0 THEN CAST(degree AS DOUBLE) / maxd * CAST(100.0 AS DOUBLE)
            ELSE CAST(0.0 AS DOUBLE) END AS degree_normalized,
       CASE WHEN maxp > 0 THEN pagerank / maxp * CAST(100.0 AS DOUBLE)
            ELSE CAST(0.0 AS DOUBLE) END AS pagerank_normalized
FROM g_net0""", "g_net0")
cte("g_net2", f"""
SELECT *, {R("degree_normalized * CAST(0.40 AS DOUBLE) + pagerank_normalized * CAST(0.60 AS DOUBLE)", 2)}
         AS network_criticality_score
FROM g_net1""", "g_net1")
cte("g_net", f"SELECT *, {_level('network_criticality_score')} AS network_risk_level FROM g_net2", "g_net2")

cte("g_crit", """
SELECT COALESCE(t.node_id, 'UNKNOWN') AS critical_network_node,
       COALESCE(t.node_type, 'UNKNOWN') AS critical_network_node_type,
       COALESCE(t.network_criticality_score, CAST(0.0 AS DOUBLE)) AS critical_network_node_score
FROM (SELECT 1 AS one) o
LEFT JOIN (SELECT node_id, node_type, network_criticality_score FROM g_net
           ORDER BY network_criticality_score DESC NULLS LAST, node_type, node_id LIMIT 1) t ON TRUE""",
    "g_net")
cte("g_res0", f"""
SELECT average_network_criticality,
       {_clamp("CAST(100.0 AS DOUBLE) - average_network_criticality")} AS graphx_resilience_score
FROM (SELECT AVG(network_criticality_score) AS average_network_criticality FROM g_net) a""", "g_net")
cte("g_res", """
SELECT *, CASE WHEN graphx_resilience_score >= 75 THEN 'HIGH RESILIENCE'
               WHEN graphx_resilience_score >= 50 THEN 'MODERATE RESILIENCE'
               ELSE 'LOW RESILIENCE' END AS graphx_resilience_level
FROM g_res0""", "g_res0")

cte("g_counts", """
SELECT s.*, w.*, r.* FROM
 (SELECT COUNT(*) AS total_suppliers,
         COUNT(*) FILTER (WHERE supplier_risk_level = 'CRITICAL') AS critical_suppliers,
         COUNT(*) FILTER (WHERE supplier_risk_level = 'HIGH') AS high_suppliers FROM g_sup) s,
 (SELECT COUNT(*) AS total_warehouses,
         COUNT(*) FILTER (WHERE warehouse_risk_level = 'CRITICAL') AS critical_warehouses,
         COUNT(*) FILTER (WHERE warehouse_risk_level = 'HIGH') AS high_warehouses FROM g_wh) w,
 (SELECT COUNT(*) AS total_routes,
         COUNT(*) FILTER (WHERE route_risk_category = 'CRITICAL') AS critical_routes,
         COUNT(*) FILTER (WHERE route_risk_category = 'HIGH') AS high_routes FROM g_rt) r""",
    "g_sup", "g_wh", "g_rt")

register("supplier_scores", q(f"""
SELECT Supplier_ID, total_orders, avg_supplier_performance, avg_supplier_risk, avg_late_delivery_risk,
       avg_delivery_delay, total_sales, {R6('supplier_risk_score')} AS supplier_risk_score, supplier_risk_level
FROM g_sup""", "g_sup"))
register("warehouse_scores", q(f"""
SELECT Warehouse_ID, Warehouse_Name, Warehouse_City, Warehouse_Capacity, Current_Inventory, Safety_Stock,
       Warehouse_Status, inventory_utilization, inventory_risk, inventory_risk_score, status_risk_score,
       {R6('warehouse_risk_score')} AS warehouse_risk_score, warehouse_risk_level
FROM g_wh""", "g_wh"))
register("route_scores", q(f"""
SELECT Route_ID, Transport_Mode, Route_Risk_Level, avg_distance_km, total_shipments, avg_delivery_delay,
       avg_late_delivery_risk, route_level_score, {R6('delay_score')} AS delay_score,
       {R6('late_delivery_score')} AS late_delivery_score, route_risk_score, route_risk_category
FROM g_rt""", "g_rt"))

_DEL6 = (f"{R6('late_delivery_percentage')} AS late_delivery_percentage, "
         f"{R6('on_time_delivery_percentage')} AS on_time_delivery_percentage, "
         f"{R6('delivery_risk_score')} AS delivery_risk_score")
register("delivery_risk", q(f"SELECT {_DEL6}, delivery_risk_level FROM g_del", "g_del"))
register("overall_risk_score", q(f"""
SELECT {R6('overall_risk_score')} AS overall_risk_score, overall_risk_level FROM g_ovr""", "g_ovr"))
register("overall_risk_from_facts", q(f"""
SELECT {R6('s')} AS overall_risk_score, {_level('s')} AS overall_risk_level
FROM (SELECT COALESCE((SELECT AVG(CAST(Overall_Risk_Score AS DOUBLE)) FROM supply_chain),
                      delivery_risk_score) AS s FROM g_del) x""", "supply_chain", "g_del"))
register("network_risk", q(f"""
SELECT node_type, node_id, degree, {R6('pagerank')} AS pagerank,
       {R6('degree_normalized')} AS degree_normalized, {R6('pagerank_normalized')} AS pagerank_normalized,
       network_criticality_score, network_risk_level
FROM g_net""", "g_net"))
register("critical_node", q("SELECT * FROM g_crit", "g_crit"))
register("network_resilience", q(f"""
SELECT {R6('average_network_criticality')} AS average_network_criticality,
       {R6('graphx_resilience_score')} AS graphx_resilience_score, graphx_resilience_level
FROM g_res""", "g_res"))
register("risk_distribution", q("""
SELECT 'SUPPLIER' AS entity_type, supplier_risk_level AS risk_level, COUNT(*) AS entity_count
FROM g_sup GROUP BY supplier_risk_level
UNION ALL
SELECT 'WAREHOUSE', warehouse_risk_level, COUNT(*) FROM g_wh GROUP BY warehouse_risk_level
UNION ALL
SELECT 'ROUTE', route_risk_category, COUNT(*) FROM g_rt GROUP BY route_risk_category""",
                                "g_sup", "g_wh", "g_rt"))
register("top_critical_suppliers", q(f"""
SELECT Supplier_ID, {R6('supplier_risk_score')} AS supplier_risk_score, supplier_risk_level,
       avg_supplier_risk, avg_late_delivery_risk, avg_delivery_delay, total_sales
FROM g_sup WHERE supplier_risk_level = 'CRITICAL'
ORDER BY g_sup.supplier_risk_score DESC NULLS LAST, Supplier_ID ASC NULLS LAST,
         supplier_risk_level ASC NULLS LAST, avg_supplier_risk ASC NULLS LAST,
         avg_late_delivery_risk ASC NULLS LAST, avg_delivery_delay ASC NULLS LAST, total_sales ASC NULLS LAST
LIMIT 10""", "g_sup"))
register("top_critical_warehouses", q(f"""
SELECT Warehouse_ID, Warehouse_Name, Warehouse_City, {R6('warehouse_risk_score')} AS warehouse_risk_score,
       warehouse_risk_level, inventory_risk, Warehouse_Status, inventory_utilization
FROM g_wh WHERE warehouse_risk_level = 'CRITICAL'
ORDER BY g_wh.warehouse_risk_score DESC NULLS LAST, Warehouse_ID ASC NULLS LAST,
         Warehouse_Name ASC NULLS LAST, Warehouse_City ASC NULLS LAST, warehouse_risk_level ASC NULLS LAST,
         inventory_risk ASC NULLS LAST, Warehouse_Status ASC NULLS LAST, inventory_utilization ASC NULLS LAST
LIMIT 10""", "g_wh"))
register("top_critical_routes", q("""
SELECT Route_ID, Transport_Mode, Route_Risk_Level, avg_distance_km, avg_delivery_delay,
       avg_late_delivery_risk, route_risk_score, route_risk_category
FROM g_rt WHERE route_risk_category = 'CRITICAL'
ORDER BY route_risk_score DESC NULLS LAST, Route_ID ASC NULLS LAST, Transport_Mode ASC NULLS LAST,
         Route_Risk_Level ASC NULLS LAST, avg_distance_km ASC NULLS LAST, avg_delivery_delay ASC NULLS LAST,
         avg_late_delivery_risk ASC NULLS LAST, route_risk_category ASC NULLS LAST
LIMIT 10""", "g_rt"))
register("risk_counts", q("SELECT * FROM g_counts", "g_counts"))
register("entity_risk", q(f"""
SELECT e.entity_id, e.entity_type, {R6('e.operational_risk_score')} AS operational_risk_score,
       e.operational_risk_level, {R6('r.graphx_resilience_score')} AS graphx_resilience_score,
       r.graphx_resilience_level
FROM (SELECT Supplier_ID AS entity_id, 'SUPPLIER' AS entity_type,
             CAST(supplier_risk_score AS DOUBLE) AS operational_risk_score,
             supplier_risk_level AS operational_risk_level FROM g_sup
      UNION ALL
      SELECT Warehouse_ID, 'WAREHOUSE', CAST(warehouse_risk_score AS DOUBLE), warehouse_risk_level FROM g_wh
      UNION ALL
      SELECT Route_ID, 'ROUTE', CAST(route_risk_score AS DOUBLE), route_risk_category FROM g_rt) e,
     g_res r""", "g_sup", "g_wh", "g_rt", "g_res"))

_ROLLUP_FROM = "FROM g_counts c, g_del d, g_ovr o, g_res r, g_crit k"
_ROLLUP_DEPS = ("g_counts", "g_del", "g_ovr", "g_res", "g_crit")
register("executive_kpis", q(f"""
SELECT c.total_suppliers, c.critical_suppliers, c.high_suppliers, c.total_warehouses, c.critical_warehouses,
       c.high_warehouses, c.total_routes, c.critical_routes, c.high_routes,
       {R6('d.late_delivery_percentage')} AS late_delivery_percentage,
       {R6('d.on_time_delivery_percentage')} AS on_time_delivery_percentage,
       {R6('d.delivery_risk_score')} AS delivery_risk_score,
       {R6('o.overall_risk_score')} AS overall_risk_score,
       {R6('r.average_network_criticality')} AS average_network_criticality,
       {R6('r.graphx_resilience_score')} AS graphx_resilience_score,
       o.overall_risk_level, d.delivery_risk_level, r.graphx_resilience_level,
       k.critical_network_node, k.critical_network_node_type, k.critical_network_node_score
{_ROLLUP_FROM}""", *_ROLLUP_DEPS))
register("resilience_summary", q(f"""
SELECT {R6('r.graphx_resilience_score')} AS graphx_resilience_score, r.graphx_resilience_level,
       {R6('r.average_network_criticality')} AS average_network_criticality,
       {R6('d.delivery_risk_score')} AS delivery_risk_score, d.delivery_risk_level,
       {R6('o.overall_risk_score')} AS overall_risk_score, o.overall_risk_level,
       k.critical_network_node, k.critical_network_node_type, k.critical_network_node_score,
       c.critical_suppliers AS critical_supplier_count, c.critical_warehouses AS critical_warehouse_count,
       c.critical_routes AS critical_route_count
{_ROLLUP_FROM}""", *_ROLLUP_DEPS))


register("csv_quarantine", q("""
SELECT CASE WHEN good THEN order_id END AS order_id, CASE WHEN good THEN delivery_delay_days END AS delivery_delay_days,
       CASE WHEN good THEN supplier END AS Supplier_ID, CASE WHEN NOT good THEN raw END AS raw_line
FROM (SELECT order_id, delivery_delay_days, coalesce(Supplier_ID, 'none') AS supplier,
             order_id % 13 <> 0 AND order_id % 17 <> 0 AS good,
             order_id || ',' || CASE WHEN order_id % 13 = 0 THEN 'x' ELSE '' END || delivery_delay_days
             || CASE WHEN order_id % 17 = 0 THEN '' ELSE ',' || coalesce(Supplier_ID, 'none') END AS raw
      FROM raw_fact WHERE delivery_delay_days IS NOT NULL) r""", "raw_fact"))
register("csv_roundtrip", q("SELECT * FROM raw_fact", "raw_fact"))
