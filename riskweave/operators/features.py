"""Row-level risk features (operators C1–C12).

Built as two projection layers (features that need only input columns, then
the ones that read layer-1 features), so the plan is two ``Project`` nodes that
Catalyst collapses into the scan's codegen stage — no shuffle, fully
streaming-compatible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.levels import at_least, at_most, lookup

FEATURE_COLUMNS = (
    "Delivery_Performance", "Delivery_Risk_Score", "Warehouse_Utilization",
    "Inventory_Status", "Inventory_Risk_Score", "DC_Utilization", "DC_Capacity_Risk",
    "Route_Risk_Score", "Supplier_Risk_Category", "Overall_Risk_Score",
    "Overall_Risk_Category",
)

RISK_PREVIEW_COLUMNS = (
    "order_id", "Supplier_ID", "Warehouse_ID", "delivery_delay_days",
    "Delivery_Performance", "Delivery_Risk_Score", "Current_Inventory", "Safety_Stock",
    "Inventory_Status", "Inventory_Risk_Score", "Warehouse_Utilization",
    "Route_Risk_Level", "Route_Risk_Score", "Supplier_Risk_Score",
    "Overall_Risk_Score", "Overall_Risk_Category",
)


def utilization(amount: Column, capacity: Column) -> Column:
    """round(amount / capacity * 100, 2); a zero or NULL capacity divides by 1."""
    return F.round(amount / F.when(capacity > 0, capacity).otherwise(1) * 100, 2)


def _inventory_band(inv: Column, safety: Column, values, default) -> Column:
    return (F.when(inv < safety, values[0])
             .when(inv <= safety * K.INVENTORY_LOW_FACTOR, values[1])
             .otherwise(default))


def delivery_performance(delay: Column) -> Column:
    return at_most(delay, K.DELIVERY_DELAY_CUTS, K.DELIVERY_PERFORMANCE_LABELS,
                   K.DELIVERY_PERFORMANCE_ELSE)


def delivery_risk_score(delay: Column) -> Column:
    return at_most(delay, K.DELIVERY_DELAY_CUTS, K.DELIVERY_RISK_SCORES, K.DELIVERY_RISK_ELSE)


def add_risk_features(df: DataFrame) -> DataFrame:
    """C1–C11 appended to the (cleaned) fact."""
    delay = F.col("delivery_delay_days")
    inv, safety = F.col("Current_Inventory"), F.col("Safety_Stock")
    layer1 = df.select(
        "*",
        delivery_performance(delay).alias("Delivery_Performance"),
        delivery_risk_score(delay).alias("Delivery_Risk_Score"),
        utilization(inv, F.col("Warehouse_Capacity")).alias("Warehouse_Utilization"),
        _inventory_band(inv, safety, K.INVENTORY_STATUS_LABELS,
                        K.INVENTORY_STATUS_ELSE).alias("Inventory_Status"),
        _inventory_band(inv, safety, K.INVENTORY_RISK_SCORES,
                        K.INVENTORY_RISK_ELSE).alias("Inventory_Risk_Score"),
        utilization(F.col("Current_Load"), F.col("DC_Capacity")).alias("DC_Utilization"),
        lookup(F.col("Route_Risk_Level"), K.ROUTE_LEVELS, K.ROUTE_RISK_SCORES,
               K.ROUTE_RISK_ELSE).alias("Route_Risk_Score"),
        at_least(F.col("Supplier_Risk_Score"), K.SUPPLIER_CATEGORY_CUTS,
                 K.SUPPLIER_CATEGORY_LABELS, K.SUPPLIER_CATEGORY_ELSE).alias("Supplier_Risk_Category"),
    )
    dc_risk = at_least(F.col("DC_Utilization"), K.DC_CAPACITY_CUTS, K.DC_CAPACITY_LABELS,
                       K.DC_CAPACITY_ELSE)
    layer2 = layer1.select("*", dc_risk.alias("DC_Capacity_Risk"))
    w_delivery, w_inventory, w_supplier, w_route, w_dc = K.OVERALL_WEIGHTS
    dc_term = lookup(F.col("DC_Capacity_Risk"), K.DC_TERM_LABELS, K.DC_TERM_SCORES, K.DC_TERM_ELSE)
    overall = F.round(
        F.col("Delivery_Risk_Score") * w_delivery
        + F.col("Inventory_Risk_Score") * w_inventory
        + F.col("Supplier_Risk_Score") * w_supplier
        + F.col("Route_Risk_Score") * w_route
        + dc_term * w_dc,
        2,
    )
    layer3 = layer2.select("*", overall.alias("Overall_Risk_Score"))
    out = layer3.select(
        "*",
        at_least(F.col("Overall_Risk_Score"), K.OVERALL_CATEGORY_CUTS, K.OVERALL_CATEGORY_LABELS,
                 K.OVERALL_CATEGORY_ELSE).alias("Overall_Risk_Category"),
    )
    ordered = [c for c in df.columns] + list(FEATURE_COLUMNS)
    return out.select(*ordered)


def risk_preview(processed: DataFrame) -> DataFrame:
    """The 16-column preview projection."""
    return processed.select(*RISK_PREVIEW_COLUMNS)
