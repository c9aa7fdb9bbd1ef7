"""Fixed values.

These thresholds, weights and labels must equal the reference pipeline's for
its results to be reproduced; they are business rules, not tuning knobs.
Each group is listed in the order the rule applies it (first match wins).
"""

# --- Row-level features (processed fact) -----------------------------------

# Delivery_Performance / Delivery_Risk_Score: delay in days, "<=" bands.
DELIVERY_DELAY_CUTS = (0, 3, 7)
DELIVERY_PERFORMANCE_LABELS = ("On Time", "Slight Delay", "Moderate Delay")
DELIVERY_PERFORMANCE_ELSE = "Severe Delay"
DELIVERY_RISK_SCORES = (0, 25, 60)
DELIVERY_RISK_ELSE = 100

# Inventory_Status / Inventory_Risk_Score: inventory vs safety stock.
INVENTORY_LOW_FACTOR = 1.5
INVENTORY_STATUS_LABELS = ("Below Safety Stock", "Low Inventory")
INVENTORY_STATUS_ELSE = "Healthy Inventory"
INVENTORY_RISK_SCORES = (100, 60)
INVENTORY_RISK_ELSE = 20

# DC_Capacity_Risk: utilisation %, ">=" bands.
DC_CAPACITY_CUTS = (90, 75, 50)
DC_CAPACITY_LABELS = ("Critical", "High", "Medium")
DC_CAPACITY_ELSE = "Low"

# Route_Risk_Score by exact Route_Risk_Level text.
ROUTE_LEVELS = ("High", "Medium", "Low")
ROUTE_RISK_SCORES = (100, 60, 20)
ROUTE_RISK_ELSE = 0

# Supplier_Risk_Category: supplier risk score, ">=" bands.
SUPPLIER_CATEGORY_CUTS = (70, 40, 20)
SUPPLIER_CATEGORY_LABELS = ("Critical", "High", "Medium")
SUPPLIER_CATEGORY_ELSE = "Low"

# Overall_Risk_Score weights: delivery, inventory, supplier, route, DC term.
OVERALL_WEIGHTS = (0.30, 0.25, 0.20, 0.15, 0.10)
# DC term of the overall score by DC_Capacity_Risk label.
DC_TERM_LABELS = ("Critical", "High", "Medium")
DC_TERM_SCORES = (100, 75, 50)
DC_TERM_ELSE = 20

# Overall_Risk_Category: ">=" bands.
OVERALL_CATEGORY_CUTS = (75, 50, 25)
OVERALL_CATEGORY_LABELS = ("Critical", "High", "Medium")
OVERALL_CATEGORY_ELSE = "Low"

# --- Aggregate reports -------------------------------------------------------

# warehouse_inventory.inventory_risk: inventory < safety x factor (decimal).
WAREHOUSE_REPORT_FACTORS = ("1.25", "1.50")
WAREHOUSE_REPORT_LABELS = ("Critical", "High", "Medium")
WAREHOUSE_REPORT_ELSE = "Low"

# distribution_center_load.load_risk: load >= capacity x factor (decimal).
DC_REPORT_FACTORS = ("0.85", "0.70")
DC_REPORT_LABELS = ("Critical", "High", "Medium")
DC_REPORT_ELSE = "Low"

TOP_SUPPLIERS_N = 10
TOP_PRODUCTS_N = 20
HIGH_RISK_RECORDS_N = 1000
HIGH_RISK_SUPPLIER_CUT = 20

# --- Graph --------------------------------------------------------------------

NODE_LAYERS = ("SUPPLIER", "WAREHOUSE", "DISTRIBUTION_CENTER", "DESTINATION")
EDGE_LAYERS = ("SUPPLIES", "SERVES", "DISTRIBUTES_TO")
PAGERANK_TOL = 1e-4
PAGERANK_RESET = 0.15
TOP_CONNECTIONS_N = 10
TOP_BY_TYPE_N = 20
TOP_BY_TYPE_TYPES = ("SUPPLIER", "WAREHOUSE", "DISTRIBUTION_CENTER")

# Node criticality blend: degree share, pagerank share.
CRITICALITY_WEIGHTS = (0.40, 0.60)

# Upper-case 75/50/25 levels shared by criticality and the resilience scores.
LEVEL_CUTS = (75, 50, 25)
LEVEL_LABELS = ("CRITICAL", "HIGH", "MEDIUM")
LEVEL_ELSE = "LOW"

# Retention resilience after a node removal: ">=" bands.
RETENTION_CUTS = (90, 75, 50)
RETENTION_LABELS = ("HIGH RESILIENCE", "GOOD RESILIENCE", "MODERATE RESILIENCE")
RETENTION_ELSE = "LOW RESILIENCE"

# --- Resilience roll-up -------------------------------------------------------

# Supplier score multipliers: avg risk, avg late, positive avg delay.
SUPPLIER_SCORE_FACTORS = (2.0, 30.0, 2.0)

# Warehouse parts: inventory risk label -> score; risky statuses; blend.
WAREHOUSE_INVENTORY_LABELS = ("critical", "high", "medium")
WAREHOUSE_INVENTORY_SCORES = (100.0, 75.0, 50.0)
WAREHOUSE_INVENTORY_ELSE = 25.0
WAREHOUSE_RISKY_STATUSES = ("under maintenance", "inactive")
WAREHOUSE_STATUS_SCORE = 75.0
WAREHOUSE_WEIGHTS = (0.70, 0.30)

# Route parts: level scores, delay and late multipliers, blend, rounding.
ROUTE_LEVEL_SCORES = (100.0, 60.0)  # High, Medium
ROUTE_LEVEL_ELSE = 20.0
ROUTE_DELAY_FACTOR = 2.5
ROUTE_LATE_FACTOR = 100.0
ROUTE_WEIGHTS = (0.40, 0.30, 0.30)
ROUTE_SCORE_DIGITS = 3

# Delivery risk: a status counts as late when it contains this text.
LATE_STATUS_TEXT = "late"

# Network resilience = 100 - average criticality: ">=" bands.
NETWORK_RESILIENCE_CUTS = (75, 50)
NETWORK_RESILIENCE_LABELS = ("HIGH RESILIENCE", "MODERATE RESILIENCE")
NETWORK_RESILIENCE_ELSE = "LOW RESILIENCE"

UNKNOWN_NODE = "UNKNOWN"
TOP_CRITICAL_ENTITIES_N = 10

TOP_EDGES_N = 20
