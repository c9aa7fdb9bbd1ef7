"""One degree table behind degrees and removals; bucketed PageRank; exact stop of components."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from riskweave.operators import graph
from riskweave.operators.components import star_components
from riskweave.plans import catalog, context
from riskweave.scratch import Scratch
from test_graph import make


def plan(df):
    return df._jdf.queryExecution().toString()


def test_degrees_and_removals_read_the_degree_table_alone(spark):
    for key in ("in_degree", "out_degree", "degree", "removal_impact_all"):
        df = catalog.QUERIES[key](spark, SF001)
        files = df.inputFiles()
        assert files and all("/incident_counts" in f for f in files)
        assert "LeftSemi" not in plan(df)
    before = context.known(spark, SF001, "valid_edges")
    catalog.QUERIES["removal_impact_top"](spark, SF001).collect()
    assert context.known(spark, SF001, "valid_edges") is before


def test_incident_counts_against_lists(spark):
    nodes, edges = make(spark, ["a", "b", "c", "d"], [("a", "a"), ("a", "a"), ("a", "b"), ("b", "a"), ("a", "zz"), ("zz", "c")])
    got = {r.node_id: (r.in_degree, r.out_degree, r.self_loops)
           for r in graph.incident_counts(nodes, graph.valid_edges(nodes, edges)).collect()}
    assert got == {"a": (3, 3, 2), "b": (1, 1, 0), "c": (0, 0, 0), "d": (0, 0, 0)}
    every = {r.failed_node_id: r.affected_edges for r in graph.removal_impact_all(nodes, edges).collect()}
    assert every == {"a": 4, "b": 2, "c": 0, "d": 0}


def test_rounds_read_bucketed_edges_without_an_exchange(spark, monkeypatch):
    monkeypatch.setattr(graph, "EDGES_PER_PARTITION", 5)
    plans, made = [], graph._round

    def spy(*args):
        out = made(*args)
        plans.append(plan(out).split("== Physical Plan ==")[1])
        return out

    monkeypatch.setattr(graph, "_round", spy)
    hub = [("hub", f"d{i}") for i in range(40)] + [(f"d{i}", f"e{i}") for i in range(40)]
    nodes, edges = make(spark, sorted({x for e in hub for x in e}), hub)
    ranks = {r.node_id: r.pagerank for r in graph.pagerank(nodes, edges).collect()}
    assert sum(ranks.values()) == pytest.approx(81) and len({round(ranks[f"d{i}"], 12) for i in range(40)}) == 1
    assert len(plans) >= 2
    for text in plans:
        lines = text.splitlines()
        at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        above = [line for line in lines[:at] if "Exchange" in line]
        join = next(i for i in range(at, -1, -1) if "Join" in lines[i])
        assert not any("Exchange" in line for line in lines[join:at]), text
        assert above  # the messages are dealt to their receivers


def test_failed_loop_leaves_no_tables(spark, monkeypatch):
    made = []
    monkeypatch.setattr(graph, "Scratch", lambda *a: made.append(Scratch(*a)) or made[-1])
    nodes, edges = make(spark, ["a", "b"], [("a", "b"), ("b", "a"), ("a", "a")])
    with pytest.raises(RuntimeError):
        graph.pagerank(nodes, edges, max_iter=1)
    assert not made[0].names and not made[0].tables


def test_components_stop_does_not_depend_on_hashes(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(1, 50)]
    got = star_components(spark.createDataFrame(edges, "src long, dst long"), Scratch(spark, "test-hash")).collect()
    assert {r.component for r in got if r.node < 1000} == {0} and {r.component for r in got if r.node >= 1000} == {1000}
    assert len(got) == 301 + 50
    none = spark.createDataFrame([(1, 1)], "src long, dst long")
    assert star_components(none, Scratch(spark, "test-none")).collect() == []
