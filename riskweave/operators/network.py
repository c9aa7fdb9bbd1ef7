"""Graph construction from the processed fact (operators E1–E14).

Node sets (E1–E4) and the three layer edge sets (E7–E9) are each built from a
single scan: every fact row is exploded into its (id, type) / (src, dst,
relationship) tuples and aggregated once, instead of one scan per layer.
Partial aggregation collapses the exploded rows map-side, so hub ids (a
warehouse serving a third of all rows) never reach one reducer un-combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..sources.tables import write_result

# (fact column, node type) per layer, in layer order.
NODE_SOURCES = tuple(zip(("Supplier_ID", "Warehouse_ID", "DC_ID", "Destination_ID"),
                         K.NODE_LAYERS))
# (src column, dst column, relationship) per edge layer.
EDGE_SOURCES = tuple(zip(("Supplier_ID", "Warehouse_ID", "DC_ID"),
                         ("Warehouse_ID", "DC_ID", "Destination_ID"),
                         K.EDGE_LAYERS))

#: Fact columns that nodes and edges read.
FACT_COLUMNS = (*(c for c, _t in NODE_SOURCES), "delivery_delay_days")

ROUTE_EDGE_COLUMNS = ("src", "dst", "Route_ID", "Distance_KM", "Transport_Mode",
                      "Route_Risk_Level", "delivery_delay_days", "late_delivery_risk")


def entity_nodes(fact: DataFrame, id_col: str, node_type: str) -> DataFrame:
    """E1–E4 individually: distinct non-NULL ids of one entity column."""
    return (fact.where(F.col(id_col).isNotNull())
                .select(F.col(id_col).cast("string").alias("node_id"),
                        F.lit(node_type).alias("node_type"))
                .distinct())


def graph_nodes(fact: DataFrame) -> DataFrame:
    """E5: all node sets in one pass, one row per ``node_id``.

    An id that appears under two types keeps the type of the lowest layer
    (supplier < warehouse < DC < destination) — a fixed rule where the
    reference keeps an arbitrary one.
    """
    tuples = F.array(*[
        F.struct(F.col(c).cast("string").alias("node_id"), F.lit(i).alias("layer"))
        for i, (c, _t) in enumerate(NODE_SOURCES)
    ])
    exploded = fact.select(F.inline(tuples)).where(F.col("node_id").isNotNull())
    per_node = exploded.groupBy("node_id").agg(F.min("layer").alias("layer"))
    type_of = F.element_at(F.array(*[F.lit(t) for _c, t in NODE_SOURCES]), F.col("layer") + 1)
    return per_node.select("node_id", type_of.alias("node_type"))


def node_type_counts(nodes: DataFrame) -> DataFrame:
    """E6."""
    return nodes.groupBy("node_type").agg(F.count(F.lit(1)).alias("node_count"))


def layer_edges(fact: DataFrame, src: str, dst: str, relationship: str) -> DataFrame:
    """E7–E9 individually: one relationship's edges with count and avg delay."""
    return (fact.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
                .groupBy(F.col(src).cast("string").alias("src"),
                         F.col(dst).cast("string").alias("dst"))
                .agg(F.count(F.lit(1)).alias("transaction_count"),
                     F.round(F.avg("delivery_delay_days"), 2).alias("avg_delivery_delay"))
                .select("src", "dst", F.lit(relationship).alias("relationship"),
                        "transaction_count", "avg_delivery_delay"))


def edge_state(fact: DataFrame) -> DataFrame:
    """E7-E10 as mergeable state of one batch of fact rows: per edge its rows
    and, for the average delay, the sum and count of non-NULL delays. One scan
    and one aggregation for the three layers."""
    tuples = F.array(*[
        F.struct(F.col(s).cast("string").alias("src"), F.col(d).cast("string").alias("dst"),
                 F.lit(rel).alias("relationship"))
        for s, d, rel in EDGE_SOURCES
    ])
    exploded = (fact.select(F.inline(tuples), "delivery_delay_days")
                    .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))
    return exploded.groupBy("src", "dst", "relationship").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("delivery_delay_days").alias("delay_sum"),
        F.count("delivery_delay_days").alias("delay_count"))


def merged_edge_state(state: DataFrame) -> DataFrame:
    """State rows of several batches added up, one row an edge."""
    return state.groupBy("src", "dst", "relationship").agg(
        *[F.sum(c).alias(c) for c in ("transactions", "delay_sum", "delay_count")])


def edges_from_state(state: DataFrame) -> DataFrame:
    """E10 from (merged) state: the rounded average is derived, never merged."""
    return state.select("src", "dst", "relationship", F.col("transactions").alias("transaction_count"),
                        F.round(F.col("delay_sum") / F.when(F.col("delay_count") > 0, F.col("delay_count")), 2)
                        .alias("avg_delivery_delay"))


def graph_edges(fact: DataFrame) -> DataFrame:
    """The three layers from one scan and one aggregation."""
    return edges_from_state(edge_state(fact))


def update_edge_state(path: str, batch: str, fact: DataFrame) -> None:
    """Add a batch of fact rows to the edge state under ``path``. Only the
    batch's rows are read. A batch that is written again replaces itself, so a
    job that failed may be run once more."""
    write_result(edge_state(fact), path, f"batch={batch}")


def read_edge_state(spark: SparkSession, path: str) -> DataFrame:
    """The edge state of all batches, merged."""
    return merged_edge_state(spark.read.parquet(path).drop("batch"))


def relationship_counts(edges: DataFrame) -> DataFrame:
    """Edges per relationship."""
    return edges.groupBy("relationship").agg(F.count(F.lit(1)).alias("edge_count"))


def route_edges(fact: DataFrame) -> DataFrame:
    """Distinct route connections warehouse -> destination."""
    return (fact.where(F.col("Route_ID").isNotNull() & F.col("Source_Warehouse").isNotNull()
                       & F.col("Destination_ID").isNotNull())
                .select(F.col("Source_Warehouse").cast("string").alias("src"),
                        F.col("Destination_ID").cast("string").alias("dst"),
                        F.col("Route_ID").cast("string").alias("Route_ID"),
                        "Distance_KM", "Transport_Mode", "Route_Risk_Level",
                        "delivery_delay_days", "late_delivery_risk")
                .distinct())


def route_network_summary(routes: DataFrame) -> DataFrame:
    """Connections per (mode, risk level) and the overall total."""
    grouped = routes.groupBy("Transport_Mode", "Route_Risk_Level").agg(
        F.count(F.lit(1)).alias("connections"))
    total = grouped.agg(F.sum("connections").alias("total_connections"))
    return grouped.join(F.broadcast(total), how="inner")


def top_connections(edges: DataFrame, n: int = K.TOP_CONNECTIONS_N,
                    relationships=K.EDGE_LAYERS) -> DataFrame:
    """Top-n edges by transaction count for each relationship.

    One bounded ``TakeOrderedAndProject`` per relationship (the set of
    relationships is fixed), so no window has to gather a whole relationship —
    possibly most of the edges — into one task.
    """
    parts = [
        edges.where(F.col("relationship") == rel)
             .orderBy(F.col("transaction_count").desc(), F.col("src"), F.col("dst"))
             .limit(n)
        for rel in relationships
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
