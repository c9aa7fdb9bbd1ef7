"""Layer 5 (test only): cross-check PageRank and components against Spark's
own GraphX library, driven through the JVM on the same graphs.

GraphX needs numeric vertex ids and reads an edge-list file, so the test maps
``node_id`` to a dense number; the engine itself never does.
"""

import os
import tempfile

import pytest

from conftest import SF01
from riskweave.operators import graph
from riskweave.plans import catalog


def _graphx(spark, edges_by_id, n_ids):
    jvm = spark.sparkContext._jvm
    try:
        loader = jvm.org.apache.spark.graphx.GraphLoader
        level = jvm.org.apache.spark.storage.StorageLevel.MEMORY_ONLY()
    except Exception:  # pragma: no cover - GraphX jar missing
        pytest.skip("GraphX not on the classpath")
    d = tempfile.mkdtemp(prefix="riskweave-graphx-", dir="/tmp")
    path = os.path.join(d, "edges.txt")
    with open(path, "w") as f:
        for s, t in edges_by_id:
            f.write(f"{s} {t}\n")
    g = loader.edgeListFile(spark.sparkContext._jsc.sc(), path, False, -1, level, level)
    pr = {t._1(): t._2() for t in g.ops().pageRank(1e-4, 0.15).vertices().collect()}
    cc = {t._1(): t._2() for t in g.ops().connectedComponents().vertices().collect()}
    return pr, cc


def _compare(spark, nodes, edges):
    valid = graph.valid_edges(nodes, edges).select("src", "dst").collect()
    ids = sorted({r["node_id"] for r in nodes.collect()})
    num = {n: i for i, n in enumerate(ids)}
    pr_lib, cc_lib = _graphx(spark, [(num[r["src"]], num[r["dst"]]) for r in valid], len(ids))
    ours = {num[r["node_id"]]: r["pagerank"] for r in graph.pagerank(nodes, edges).collect()}
    comps = {num[r["node_id"]]: num[r["component_id"]]
             for r in graph.connected_components(nodes, edges).collect()}
    # GraphX only knows vertices that have edges; the graphs here have no isolated node.
    assert set(ours) == set(pr_lib)
    for v, p in pr_lib.items():
        assert ours[v] == pytest.approx(p, abs=1e-9)
    # Same partition of the vertices (GraphX labels by min numeric id = min node_id here).
    assert {v: comps[v] for v in cc_lib} == cc_lib


def test_graphx_tiny(spark):
    from test_graph import TINY_EDGES, TINY_PAGERANK, make
    nodes, edges = make(spark, list(TINY_PAGERANK), TINY_EDGES)
    _compare(spark, nodes, edges)


def test_graphx_sf001_graph(spark):
    _compare(spark, catalog.nodes_table(spark, SF01), catalog.edges_table(spark, SF01))


def test_graphx_uneven_cycles_self_loop_parallel_edges(spark):
    import random
    from test_graph import make
    r = random.Random(2)
    ids = [f"n{i:02d}" for i in range(30)]
    edges = [(ids[i], ids[(i + 1) % 30]) for i in range(30)] + [(r.choice(ids), r.choice(ids)) for _ in range(25)]
    edges += [("n03", "n03"), ("n05", "n06"), ("n05", "n06")]
    _compare(spark, *make(spark, ids, edges))
