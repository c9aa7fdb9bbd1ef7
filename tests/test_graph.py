"""Graph operators on the tiny and odd fixture graphs (FIXTURES.md §3)."""

import pytest

from riskweave.operators import graph

NODE_SCHEMA = "node_id string, node_type string"
EDGE_SCHEMA = ("src string, dst string, relationship string, transaction_count bigint, "
               "avg_delivery_delay double")

TINY_EDGES = [("1", "11"), ("1", "12"), ("2", "12"), ("11", "21"), ("12", "21"), ("12", "22"),
              ("21", "31"), ("22", "31"), ("22", "32")]
# Spark GraphX pageRank(tol=1e-4) on the tiny graph (FIXTURES.md §3).
TINY_PAGERANK = {"1": 0.464623, "2": 0.464623, "11": 0.662088, "12": 1.057018, "21": 1.476631,
                 "22": 0.913856, "31": 2.108148, "32": 0.853012}


def make(spark, node_ids, edges, node_type="T"):
    nodes = spark.createDataFrame([(n, node_type) for n in node_ids], NODE_SCHEMA)
    e = spark.createDataFrame([(s, d, "R", 1, None) for s, d in edges], EDGE_SCHEMA)
    return nodes, e


@pytest.fixture(scope="module")
def tiny(spark):
    return make(spark, list(TINY_PAGERANK), TINY_EDGES)


def test_tiny_pagerank_matches_library(tiny):
    pr = {r["node_id"]: r["pagerank"] for r in graph.pagerank(*tiny).collect()}
    assert set(pr) == set(TINY_PAGERANK)
    for k, v in TINY_PAGERANK.items():
        assert pr[k] == pytest.approx(v, abs=1e-6)
    assert sum(pr.values()) == pytest.approx(8.0, abs=1e-9)


def test_tiny_degrees_and_components(tiny):
    deg = {r["node_id"]: r["degree"] for r in graph.degree(*tiny).collect()}
    ind = {r["node_id"]: r["in_degree"] for r in graph.in_degree(*tiny).collect()}
    outd = {r["node_id"]: r["out_degree"] for r in graph.out_degree(*tiny).collect()}
    assert sum(ind.values()) == sum(outd.values()) == len(TINY_EDGES)
    assert sum(deg.values()) == 2 * len(TINY_EDGES)
    assert deg["12"] == 4 and "1" not in ind and "31" not in outd
    comps = graph.connected_components(*tiny).collect()
    assert {r["component_id"] for r in comps} == {"1"}


def test_removal_impact_invariants(spark, tiny):
    nodes, edges = tiny
    pr = graph.pagerank(nodes, edges)
    r = graph.removal_impact(nodes, edges, pr, "pagerank").collect()[0]
    assert r["failed_node_id"] == "31"
    assert r["affected_edges"] == 2 and r["remaining_edges"] == 7 and r["remaining_vertices"] == 7
    assert r["affected_percentage"] + r["resilience_score"] == pytest.approx(100.0)
    every = {x["failed_node_id"]: x for x in graph.removal_impact_all(nodes, edges).collect()}
    assert every["31"]["affected_edges"] == 2 and every["12"]["affected_edges"] == 4


def test_odd_graphs(spark):
    # empty graph
    n, e = make(spark, [], [])
    assert graph.pagerank(n, e).count() == 0
    assert graph.connected_components(n, e).count() == 0
    # isolated nodes only: every rank is 1 (sum normalised to N)
    n, e = make(spark, ["a", "b"], [])
    assert {r["pagerank"] for r in graph.pagerank(n, e).collect()} == {1.0}
    assert graph.degree(n, e).count() == 0
    # dangling edge end is dropped; self-loop counts twice in degree, once in removal impact
    n, e = make(spark, ["a", "b|x"], [("a", "b|x"), ("a", "zz"), ("a", "a")])
    assert graph.valid_edges(n, e).count() == 2
    deg = {r["node_id"]: r["degree"] for r in graph.degree(n, e).collect()}
    assert deg == {"a": 3, "b|x": 1}
    imp = {r["failed_node_id"]: r["affected_edges"] for r in graph.removal_impact_all(n, e).collect()}
    assert imp == {"a": 2, "b|x": 1}
    # a cycle is symmetric: all ranks equal 1
    n, e = make(spark, ["a", "b", "c"], [("a", "b"), ("b", "c"), ("c", "a")])
    assert all(abs(r["pagerank"] - 1.0) < 1e-9 for r in graph.pagerank(n, e).collect())
    # two components labelled by their smallest id
    n, e = make(spark, ["a", "b", "c", "d", "e"], [("b", "a"), ("d", "c"), ("e", "d")])
    comp = {r["node_id"]: r["component_id"] for r in graph.connected_components(n, e).collect()}
    assert comp == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "c"}


def test_same_id_two_types_keeps_lowest_layer(spark):
    from riskweave.operators import network
    from test_features import fact_rows
    f = fact_rows(spark, [dict(Supplier_ID="X", Warehouse_ID="X", DC_ID="D", Destination_ID=None)])
    nodes = {r["node_id"]: r["node_type"] for r in network.graph_nodes(f).collect()}
    assert nodes == {"X": "SUPPLIER", "D": "DISTRIBUTION_CENTER"}
    edges = network.graph_edges(f).collect()
    assert {(r["src"], r["dst"], r["relationship"]) for r in edges} == {("X", "X", "SUPPLIES"),
                                                                       ("X", "D", "SERVES")}
    assert all(r["avg_delivery_delay"] is None for r in edges)


def test_hot_source_split_does_not_change_results(spark, monkeypatch):
    """A hub with most of the edges is 'hot' at some partition counts and not
    at others; PageRank and components must not depend on that. One edge per
    partition lets the shuffle-partition cap set the edge partitioning."""
    monkeypatch.setattr(graph, "EDGES_PER_PARTITION", 1)
    hub_edges = [(f"s{i}", "hub") for i in range(40)] + [("hub", f"d{i}") for i in range(3)]
    chain = [(f"c{i}", f"c{i + 1}") for i in range(4)] + [("d0", "c3")]
    ids = sorted({x for e in hub_edges + chain for x in e} | {"lonely"})
    nodes, edges = make(spark, ids, hub_edges + chain)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("1", "8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            pr = {r["node_id"]: round(r["pagerank"], 9) for r in graph.pagerank(nodes, edges).collect()}
            cc = {r["node_id"]: r["component_id"] for r in graph.connected_components(nodes, edges).collect()}
            results.append((pr, cc))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
    pr, cc = results[0]
    assert sum(pr.values()) == pytest.approx(len(ids), abs=1e-6)
    assert cc["lonely"] == "lonely" and cc["s5"] == cc["c4"] == "c0"
