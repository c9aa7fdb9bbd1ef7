"""Resilience roll-up over the (rounded) reports and graph measures.

Inputs are the report tables exactly as the reports produce them (rounded
values), as the reference reads them back from Parquet. Every scalar the
reference collects to the driver (late share, maxima, averages, the critical
node) is a one-row aggregate here, attached with a broadcast join of that one
row, so the whole roll-up stays one lazy, distributed plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.levels import at_least, clamp, lookup, risk_level


def _one_row_join(*frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates side by side (each is exactly one row)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(F.broadcast(f), how="inner")
    return out


def _norm_text(c: str) -> Column:
    return F.lower(F.trim(F.col(c)))


# --- G1–G2 -------------------------------------------------------------------

def supplier_scores(supplier_report: DataFrame) -> DataFrame:
    """Score = clamp(2·avg risk + 30·avg late + 2·max(avg delay, 0)) and level.

    A NULL average makes the sum NULL, and ``greatest``/``least`` skip NULLs,
    so such a supplier scores 0 (LOW), as in the reference."""
    f_risk, f_late, f_delay = K.SUPPLIER_SCORE_FACTORS
    delay = F.col("avg_delivery_delay").cast("double")
    raw = (F.col("avg_supplier_risk").cast("double") * f_risk
           + F.col("avg_late_delivery_risk").cast("double") * f_late
           + F.when(delay > 0.0, delay * f_delay).otherwise(F.lit(0.0)))
    scored = supplier_report.select("*", clamp(raw).alias("supplier_risk_score"))
    return scored.select("*", risk_level(F.col("supplier_risk_score")).alias("supplier_risk_level"))


# --- G3–G6 -------------------------------------------------------------------

def warehouse_scores(warehouse_report: DataFrame) -> DataFrame:
    inv_label = _norm_text("inventory_risk")
    inventory = lookup(inv_label, K.WAREHOUSE_INVENTORY_LABELS, K.WAREHOUSE_INVENTORY_SCORES,
                       K.WAREHOUSE_INVENTORY_ELSE)
    status = (F.when(_norm_text("Warehouse_Status").isin(*K.WAREHOUSE_RISKY_STATUSES),
                     F.lit(K.WAREHOUSE_STATUS_SCORE)).otherwise(F.lit(0.0)))
    w_inv, w_status = K.WAREHOUSE_WEIGHTS
    parts = warehouse_report.select("*", inventory.alias("inventory_risk_score"),
                                    status.alias("status_risk_score"))
    scored = parts.select("*", F.least(F.lit(100.0), F.col("inventory_risk_score") * w_inv
                                       + F.col("status_risk_score") * w_status)
                          .alias("warehouse_risk_score"))
    critical_label = K.WAREHOUSE_INVENTORY_LABELS[0]
    level = F.when(inv_label == critical_label, F.lit(K.LEVEL_LABELS[0])) \
             .otherwise(risk_level(F.col("warehouse_risk_score")))
    return scored.select("*", level.alias("warehouse_risk_level"))


# --- G7–G8 -------------------------------------------------------------------

def route_scores(route_report: DataFrame) -> DataFrame:
    level = lookup(F.col("Route_Risk_Level"), K.ROUTE_LEVELS[:2], K.ROUTE_LEVEL_SCORES,
                   K.ROUTE_LEVEL_ELSE)
    delay = clamp(F.col("avg_delivery_delay").cast("double") * K.ROUTE_DELAY_FACTOR)
    late = clamp(F.col("avg_late_delivery_risk").cast("double") * K.ROUTE_LATE_FACTOR)
    parts = route_report.select("*", level.alias("route_level_score"), delay.alias("delay_score"),
                                late.alias("late_delivery_score"))
    w_level, w_delay, w_late = K.ROUTE_WEIGHTS
    score = F.round(F.col("route_level_score") * w_level + F.col("delay_score") * w_delay
                    + F.col("late_delivery_score") * w_late, K.ROUTE_SCORE_DIGITS)
    scored = parts.select("*", score.alias("route_risk_score"))
    return scored.select("*", risk_level(F.col("route_risk_score")).alias("route_risk_category"))


# --- G9 ----------------------------------------------------------------------

def delivery_risk(delivery_report: DataFrame) -> DataFrame:
    """One row: late share of shipments (status containing "late", any case or
    padding), on-time share = the rest, score = clamped late share, level."""
    shipments = F.col("total_shipments").cast("double")
    is_late = _norm_text("delivery_status").contains(K.LATE_STATUS_TEXT)
    sums = delivery_report.agg(
        F.coalesce(F.sum(F.when(is_late, shipments)), F.lit(0.0)).alias("_late"),
        F.coalesce(F.sum(shipments), F.lit(0.0)).alias("_total"),
    )
    late_pct = F.when(F.col("_total") > 0, F.col("_late") / F.col("_total") * 100.0) \
                .otherwise(F.lit(0.0))
    out = sums.select(late_pct.alias("late_delivery_percentage"))
    out = out.select("*", (F.lit(100.0) - F.col("late_delivery_percentage"))
                     .alias("on_time_delivery_percentage"),
                     clamp(F.col("late_delivery_percentage")).alias("delivery_risk_score"))
    return out.select("*", risk_level(F.col("delivery_risk_score")).alias("delivery_risk_level"))


# --- G10 ---------------------------------------------------------------------

def with_overall_risk(risk_table: DataFrame, delivery: DataFrame,
                      column: str = "Overall_Risk_Score") -> DataFrame:
    """The delivery row plus the overall risk score and level: the average of
    ``column`` when the table has it (falling back to the delivery risk score
    when that average is NULL), else the delivery risk score itself."""
    fallback = F.col("delivery_risk_score")
    if column in risk_table.columns:
        avg = risk_table.agg(F.avg(F.col(column).cast("double")).alias("_avg"))
        row = _one_row_join(delivery, avg)
        score = F.coalesce(F.col("_avg"), fallback)
    else:
        row = delivery
        score = fallback
    out = row.select(*delivery.columns, score.alias("overall_risk_score"))
    return out.select("*", risk_level(F.col("overall_risk_score")).alias("overall_risk_level"))


def overall_risk_score(risk_table: DataFrame, delivery: DataFrame,
                       column: str = "Overall_Risk_Score") -> DataFrame:
    """G10 as its own one-row table."""
    return with_overall_risk(risk_table, delivery, column).select("overall_risk_score",
                                                                  "overall_risk_level")


# --- G11–G13 -----------------------------------------------------------------

def network_risk(deg: DataFrame, pr: DataFrame) -> DataFrame:
    """Degree LEFT JOIN PageRank on (type, id); max-normalised 40/60 blend."""
    w_deg, w_pr = K.CRITICALITY_WEIGHTS
    both = deg.select("node_type", "node_id", "degree").join(
        pr.select("node_type", "node_id", "pagerank"), ["node_type", "node_id"], "left")
    maxima = both.agg(F.max("degree").cast("double").alias("_maxd"),
                      F.max("pagerank").alias("_maxp"))
    joined = both.join(F.broadcast(maxima), how="inner")

    def norm(value, mx):
        return F.when(F.col(mx) > 0.0, F.col(value).cast("double") / F.col(mx) * 100.0) \
                .otherwise(F.lit(0.0))

    scored = joined.select("node_type", "node_id", "degree", "pagerank",
                           norm("degree", "_maxd").alias("degree_normalized"),
                           norm("pagerank", "_maxp").alias("pagerank_normalized"))
    scored = scored.select("*", F.round(F.col("degree_normalized") * w_deg
                                        + F.col("pagerank_normalized") * w_pr, 2)
                           .alias("network_criticality_score"))
    return scored.select("*", risk_level(F.col("network_criticality_score"))
                         .alias("network_risk_level"))


def _network_row(net: DataFrame) -> DataFrame:
    """One aggregate: the average criticality and the top node. The top node is
    ``min_by`` over (−score, type, id) — the highest score, ties by type then
    id — with NULL scores ordered last, as ``ORDER BY score DESC`` puts them."""
    score = F.col("network_criticality_score")
    order = F.struct(F.coalesce(-score, F.lit(float("inf"))).alias("k"),
                     F.col("node_type").alias("t"), F.col("node_id").alias("n"))
    top = F.struct(F.col("node_id").alias("n"), F.col("node_type").alias("t"), score.alias("s"))
    return net.agg(F.avg(score).alias("average_network_criticality"),
                   F.min_by(top, order).alias("_top"))


def _critical_columns() -> list[Column]:
    return [
        F.coalesce(F.col("_top.n"), F.lit(K.UNKNOWN_NODE)).alias("critical_network_node"),
        F.coalesce(F.col("_top.t"), F.lit(K.UNKNOWN_NODE)).alias("critical_network_node_type"),
        F.coalesce(F.col("_top.s"), F.lit(0.0)).alias("critical_network_node_score"),
    ]


def _resilience_columns(avg: Column) -> list[Column]:
    score = clamp(F.lit(100.0) - avg)
    level = at_least(score, K.NETWORK_RESILIENCE_CUTS, K.NETWORK_RESILIENCE_LABELS,
                     K.NETWORK_RESILIENCE_ELSE)
    return [avg.alias("average_network_criticality"), score.alias("graphx_resilience_score"),
            level.alias("graphx_resilience_level")]


def critical_node(net: DataFrame) -> DataFrame:
    """G12, one row: the highest-scoring node (ties by type, id); UNKNOWN / 0.0
    when there is none."""
    return _network_row(net).select(*_critical_columns())


def network_resilience(net: DataFrame) -> DataFrame:
    """G13, one row: average criticality, resilience = clamp(100 - average), level."""
    return _network_row(net).select(*_resilience_columns(F.col("average_network_criticality")))


def network_summary(net: DataFrame) -> DataFrame:
    """G12 + G13 from the same single aggregate (used by the roll-ups)."""
    return _network_row(net).select(*_resilience_columns(F.col("average_network_criticality")),
                                    *_critical_columns())


# --- G14–G16 -----------------------------------------------------------------

def risk_distribution(suppliers: DataFrame, warehouses: DataFrame, routes: DataFrame) -> DataFrame:
    """Level counts per entity type."""
    parts = [
        suppliers.groupBy(F.col("supplier_risk_level").alias("risk_level"))
                 .agg(F.count(F.lit(1)).alias("entity_count"))
                 .select(F.lit("SUPPLIER").alias("entity_type"), "*"),
        warehouses.groupBy(F.col("warehouse_risk_level").alias("risk_level"))
                  .agg(F.count(F.lit(1)).alias("entity_count"))
                  .select(F.lit("WAREHOUSE").alias("entity_type"), "*"),
        routes.groupBy(F.col("route_risk_category").alias("risk_level"))
              .agg(F.count(F.lit(1)).alias("entity_count"))
              .select(F.lit("ROUTE").alias("entity_type"), "*"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SUPPLIER_TOP_COLUMNS = ("Supplier_ID", "supplier_risk_score", "supplier_risk_level",
                        "avg_supplier_risk", "avg_late_delivery_risk", "avg_delivery_delay",
                        "total_sales")
WAREHOUSE_TOP_COLUMNS = ("Warehouse_ID", "Warehouse_Name", "Warehouse_City", "warehouse_risk_score",
                         "warehouse_risk_level", "inventory_risk", "Warehouse_Status",
                         "inventory_utilization")
ROUTE_TOP_COLUMNS = ("Route_ID", "Transport_Mode", "Route_Risk_Level", "avg_distance_km",
                     "avg_delivery_delay", "avg_late_delivery_risk", "route_risk_score",
                     "route_risk_category")


def top_critical_entities(scored: DataFrame, level_col: str, score_col: str, columns,
                          n: int = K.TOP_CRITICAL_ENTITIES_N) -> DataFrame:
    """Top-n CRITICAL entities by score; every column breaks ties."""
    rest = [c for c in columns if c != score_col]
    return (scored.where(F.col(level_col) == K.LEVEL_LABELS[0]).select(*columns)
                  .orderBy(F.col(score_col).desc_nulls_last(),
                           *[F.col(c).asc_nulls_last() for c in rest])
                  .limit(n))


def risk_counts(suppliers: DataFrame, warehouses: DataFrame, routes: DataFrame) -> DataFrame:
    """Totals and CRITICAL/HIGH counts per entity, as one conditional
    aggregate over the union of the three level columns."""
    crit, high = K.LEVEL_LABELS[0], K.LEVEL_LABELS[1]
    levels = (suppliers.select(F.lit("suppliers").alias("_e"), F.col("supplier_risk_level").alias("_l"))
              .unionByName(warehouses.select(F.lit("warehouses").alias("_e"),
                                             F.col("warehouse_risk_level").alias("_l")))
              .unionByName(routes.select(F.lit("routes").alias("_e"),
                                         F.col("route_risk_category").alias("_l"))))
    aggs = []
    for name in ("suppliers", "warehouses", "routes"):
        mine = F.col("_e") == name
        aggs += [F.count_if(mine).alias(f"total_{name}"),
                 F.count_if(mine & (F.col("_l") == crit)).alias(f"critical_{name}"),
                 F.count_if(mine & (F.col("_l") == high)).alias(f"high_{name}")]
    return levels.agg(*aggs)


# --- G17–G19 -----------------------------------------------------------------

def entity_risk(suppliers: DataFrame, warehouses: DataFrame, routes: DataFrame,
                resilience: DataFrame) -> DataFrame:
    def part(df, id_col, kind, score, level):
        return df.select(F.col(id_col).cast("string").alias("entity_id"),
                         F.lit(kind).alias("entity_type"),
                         F.col(score).cast("double").alias("operational_risk_score"),
                         F.col(level).alias("operational_risk_level"))

    union = (part(suppliers, "Supplier_ID", "SUPPLIER", "supplier_risk_score", "supplier_risk_level")
             .unionByName(part(warehouses, "Warehouse_ID", "WAREHOUSE", "warehouse_risk_score",
                               "warehouse_risk_level"))
             .unionByName(part(routes, "Route_ID", "ROUTE", "route_risk_score", "route_risk_category")))
    return union.join(F.broadcast(resilience.select("graphx_resilience_score",
                                                    "graphx_resilience_level")), how="inner")


EXECUTIVE_COLUMNS = (
    "total_suppliers", "critical_suppliers", "high_suppliers",
    "total_warehouses", "critical_warehouses", "high_warehouses",
    "total_routes", "critical_routes", "high_routes",
    "late_delivery_percentage", "on_time_delivery_percentage", "delivery_risk_score",
    "overall_risk_score", "average_network_criticality", "graphx_resilience_score",
    "overall_risk_level", "delivery_risk_level", "graphx_resilience_level",
    "critical_network_node", "critical_network_node_type", "critical_network_node_score",
)

SUMMARY_COLUMNS = (
    "graphx_resilience_score", "graphx_resilience_level", "average_network_criticality",
    "delivery_risk_score", "delivery_risk_level", "overall_risk_score", "overall_risk_level",
    "critical_network_node", "critical_network_node_type", "critical_network_node_score",
    "critical_supplier_count", "critical_warehouse_count", "critical_route_count",
)


def executive_kpis(counts: DataFrame, delivery_overall: DataFrame, network: DataFrame) -> DataFrame:
    """One row, 21 columns, from three one-row aggregates
    (``risk_counts``, ``with_overall_risk``, ``network_summary``)."""
    return _one_row_join(counts, delivery_overall, network).select(*EXECUTIVE_COLUMNS)


def resilience_summary(counts: DataFrame, delivery_overall: DataFrame, network: DataFrame) -> DataFrame:
    """One row, 13 columns, from the same three one-row aggregates."""
    row = _one_row_join(counts, delivery_overall, network)
    return row.select(
        *[c for c in SUMMARY_COLUMNS if not c.endswith("_count")],
        F.col("critical_suppliers").alias("critical_supplier_count"),
        F.col("critical_warehouses").alias("critical_warehouse_count"),
        F.col("critical_routes").alias("critical_route_count"),
    ).select(*SUMMARY_COLUMNS)
