"""Every result of the pipeline as a Parquet directory, from one raw fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features, graph, network, report_pass, reports, resilience
from ..scratch import Scratch
from ..sources.tables import read_table, write_result

REPORTS = ("overall_kpi", "delivery_performance", "region_analysis", "supplier_risk", "top_high_risk_suppliers",
           "warehouse_inventory", "distribution_center_load", "route_risk", "transport_mode", "product_performance",
           "category_performance", "disruption_events", "overall_risk", "high_risk_records")


def write_all(spark: SparkSession, raw_fact: DataFrame, base: str) -> dict[str, str]:
    """Clean and score ``raw_fact`` and write the processed fact, the reports,
    the graph, its analytics and the resilience roll-up under ``base``, each
    stage reading what the one before wrote. Returns the directories by name."""
    paths: dict[str, str] = {}

    def written(name: str, df: DataFrame) -> DataFrame:
        paths[name] = write_result(df, base, name)
        return read_table(spark, paths[name])

    fact = written("processed_fact", features.add_risk_features(clean.clean_fact(raw_fact)))
    # the grouped reports share one scan of the fact
    scratch = Scratch(spark, "report-groups")
    groups = report_pass.written_groups(report_pass.report_groups(fact), scratch)
    report = {name: written(name, report_pass.report(groups, name) if name in report_pass.GROUPINGS
                            else getattr(reports, name)(fact)) for name in REPORTS}
    scratch.clear()

    nodes = written("graph_nodes", network.graph_nodes(fact))
    edges = written("graph_edges", network.graph_edges(fact))
    routes = written("route_edges", network.route_edges(fact))
    written("route_network_summary", network.route_network_summary(routes))
    written("top_connections", network.top_connections(edges))

    written("edge_criticality", graph.edge_criticality(nodes, edges))
    incident = written("incident_counts", graph.incident_counts(nodes, graph.valid_edges(nodes, edges)))
    written("in_degree", graph.in_degree_from(incident))
    written("out_degree", graph.out_degree_from(incident))
    degree = written("degree", graph.degree_from(incident))
    ranks = written("pagerank", graph.pagerank(nodes, edges))
    written("top_pagerank_by_type", graph.top_by_type(ranks, "pagerank"))
    components = written("connected_components", graph.connected_components(nodes, edges))
    written("component_sizes", graph.component_sizes(components))
    critical = written("critical_nodes", graph.node_criticality(ranks, degree))
    written("top_critical_by_type", graph.top_by_type(critical, "criticality_score"))
    written("top_critical_edges", graph.top_critical_edges(nodes, edges))
    written("removal_impact_top", graph.removal_impact_from(incident, critical, "criticality_score"))
    written("removal_impact_pagerank", graph.removal_impact_from(incident, ranks, "pagerank"))
    written("removal_impact_all", graph.removal_impact_all_from(incident))

    suppliers = written("supplier_scores", resilience.supplier_scores(report["supplier_risk"]))
    warehouses = written("warehouse_scores", resilience.warehouse_scores(report["warehouse_inventory"]))
    lanes = written("route_scores", resilience.route_scores(report["route_risk"]))
    delivery = written("delivery_risk", resilience.delivery_risk(report["delivery_performance"]))
    risk = written("network_risk", resilience.network_risk(degree, ranks))
    resilient = written("network_resilience", resilience.network_resilience(risk))
    written("entity_risk", resilience.entity_risk(suppliers, warehouses, lanes, resilient))
    written("risk_distribution", resilience.risk_distribution(suppliers, warehouses, lanes))
    parts = (resilience.risk_counts(suppliers, warehouses, lanes),
             resilience.with_overall_risk(report["overall_risk"], delivery), resilience.network_summary(risk))
    written("executive_kpis", resilience.executive_kpis(*parts))
    written("resilience_summary", resilience.resilience_summary(*parts))
    return paths
