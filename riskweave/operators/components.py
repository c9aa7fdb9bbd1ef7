"""Connected components in a logarithmic number of rounds.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each step links the neighbours of a
node to the smallest of them, so long paths shrink by a constant factor per
round instead of by one node.

The loop ends when every node is settled: either all its neighbours are larger
(a root) or it has one neighbour, a smaller one (a leaf). Then the edges are
stars around the smallest nodes of their components, and each step keeps
components, so the result is exact. The job that writes the minima of a round
counts the nodes that are not settled; no job compares whole states. The last
minima name the component of every node, so they are the result.

Minima are aggregated before the shuffle and written, so the join of a hub's
edges with its minimum has a plain file on either side and AQE may split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def star_components(edges: DataFrame, scratch: Scratch, src: str = "src", dst: str = "dst",
                    on_round=None, name: str = "cc") -> DataFrame:
    """(node, component) for every node with an edge to another one; the
    component is its smallest node. The result is a table in ``scratch``, of
    that ``name`` and a suffix; runs that share a ``scratch`` take names of
    their own. Edges may repeat."""
    now = scratch.table(edges.select(F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo"))
                        .where("hi <> lo"), f"{name}-0")
    rounds = 0
    while True:
        rounds += 1
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        nodes = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("far"))
        least, seen = scratch.counted(nodes, f"{name}-least-{rounds}",
                                      unsettled=F.count_if((F.col("m") < F.col("u")) & (F.col("far") > F.col("m"))))
        if on_round:
            on_round(rounds)
        if not seen["unsettled"]:
            scratch.drop(f"{name}-{rounds - 1}")
            return least.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        large = scratch.table(both.join(least.select("u", F.least("u", "m").alias("m")), "u").where("v > u")
                              .select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct(),
                              f"{name}-large-{rounds}")
        lowest = scratch.table(large.groupBy("hi").agg(F.min("lo").alias("m")), f"{name}-lowest-{rounds}")
        now = scratch.table(
            large.join(lowest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(lowest.select("hi", F.col("m").alias("lo"))).distinct(), f"{name}-{rounds}")
        scratch.drop(f"{name}-{rounds - 1}", f"{name}-least-{rounds}", f"{name}-large-{rounds}", f"{name}-lowest-{rounds}")
