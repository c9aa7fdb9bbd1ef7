"""E1–E4 / E7–E9 individually equal the one-scan builders; D14 plan."""

from conftest import SF01
from riskweave.operators import network, reports
from riskweave.plans import catalog


def test_entity_and_layer_builders_match_one_scan_versions(spark):
    fact = catalog.processed_fact(spark, SF01)
    parts = [network.entity_nodes(fact, c, t) for c, t in network.NODE_SOURCES]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    # No id is shared across types in the fixture, so the plain union is the node set.
    assert union.count() == union.select("node_id").distinct().count()
    assert union.exceptAll(network.graph_nodes(fact).select("node_id", "node_type")).count() == 0
    assert network.graph_nodes(fact).count() == union.count()

    layers = [network.layer_edges(fact, s, d, r) for s, d, r in network.EDGE_SOURCES]
    edges = layers[0]
    for p in layers[1:]:
        edges = edges.unionByName(p)
    one_scan = network.graph_edges(fact).select(*edges.columns)
    assert edges.count() == one_scan.count() == 680
    assert edges.exceptAll(one_scan).count() == 0


def test_high_risk_top_k_keeps_the_scan_and_limits_before_the_exchange(spark):
    fact = catalog.processed_fact(spark, SF01)
    plan = reports.high_risk_records(fact)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan
    assert plan.index("Exchange hashpartitioning(_bucket") < plan.rindex("WindowGroupLimit")
