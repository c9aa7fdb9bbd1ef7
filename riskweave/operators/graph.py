"""Graph analytics on (nodes, edges) DataFrames (operators F2–F19).

The property graph is two DataFrames keyed by the string ``node_id``; no numeric
vertex ids and no driver-side id map. Iterative operators (PageRank, connected
components) are DataFrame loops whose only driver values are convergence
checks; lineage is cut with tables in the session's shared checkpoint folder
(``spark.checkpoint.dir``), never machine-local storage.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.levels import at_least, risk_level
from ..scratch import Scratch
from .components import star_components


def valid_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """keep edges whose both ends are known nodes (two semi joins)."""
    ids = nodes.select("node_id")
    return (edges.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi")
                 .join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
                 .select(*edges.columns))


def incident_counts(nodes: DataFrame, valid: DataFrame) -> DataFrame:
    """The degree table that F3-F6 and F14-F19 read: for every node its in- and
    out-edges and its self-loops among the valid edges (0 if it has none). One
    shuffle of the edges' ends, combined before it."""
    loop = (F.col("src") == F.col("dst")).cast("long")
    ends = F.array(F.struct(F.col("src").alias("node_id"), F.lit(0).cast("long").alias("i"),
                            F.lit(1).cast("long").alias("o"), loop.alias("l")),
                   F.struct(F.col("dst").alias("node_id"), F.lit(1).cast("long").alias("i"),
                            F.lit(0).cast("long").alias("o"), F.lit(0).cast("long").alias("l")))
    counts = (valid.select(F.inline(ends)).groupBy("node_id")
              .agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.sum("l").alias("self_loops")))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("in_degree", "out_degree", "self_loops")]
    return nodes.join(counts, "node_id", "left").select("node_type", "node_id", *zero)


def _incident(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return incident_counts(nodes, valid_edges(nodes, edges))


def stats_from(incident: DataFrame) -> DataFrame:
    """F3 from the degree table."""
    return incident.agg(F.count(F.lit(1)).alias("vertex_count"),
                        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("long").alias("edge_count"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """vertex and (valid) edge counts as one row."""
    return stats_from(_incident(nodes, edges))


def in_degree_from(incident: DataFrame) -> DataFrame:
    return incident.where("in_degree > 0").select("node_type", "node_id", "in_degree")


def in_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with at least one in-edge."""
    return in_degree_from(_incident(nodes, edges))


def out_degree_from(incident: DataFrame) -> DataFrame:
    return incident.where("out_degree > 0").select("node_type", "node_id", "out_degree")


def out_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with at least one out-edge."""
    return out_degree_from(_incident(nodes, edges))


def degree_from(incident: DataFrame) -> DataFrame:
    return (incident.where("in_degree + out_degree > 0")
            .select("node_type", "node_id", (F.col("in_degree") + F.col("out_degree")).alias("degree")))


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """in + out degree; isolated nodes are absent; a self-loop counts twice."""
    return degree_from(_incident(nodes, edges))


#: Edges of one loop partition. A source with more out-edges is dealt over
#: several salts, so no task holds more than about this many edges of one key.
EDGES_PER_PARTITION = 2_000_000


def pagerank(nodes: DataFrame, edges: DataFrame, tol: float = K.PAGERANK_TOL,
             reset: float = K.PAGERANK_RESET, max_iter: int | None = None) -> DataFrame:
    """unweighted PageRank until convergence, ranks summing to the node count.

    Same recurrence as GraphX's ``pageRank(tol)``: every vertex starts at
    ``reset`` with that as its last change; each round, vertices whose last
    change exceeds ``tol`` and that changed in the previous round send
    ``change / out_degree`` along their out-edges; a receiving vertex adds
    ``(1 - reset) * sum``. It stops when nobody can send; finally ranks are
    scaled by N / sum so they add up to the number of nodes (isolated nodes
    included). With ``max_iter``, a run that would need more rounds raises.

    The valid edges become one table in buckets of (src, salt), sorted, about
    ``EDGES_PER_PARTITION`` edges a bucket; every round reads it bucket by bucket,
    without an exchange, and a lost executor rereads files. A round moves only
    vertex-sized data (a sender's row once per salt, the map-side combined
    messages, the state). Each round's state is a table in the shared checkpoint
    folder, whose job also counts who can send; the one before is deleted. The
    last state stays; the other tables go, also if the loop raises.
    """
    scratch = Scratch(nodes.sparkSession, "pagerank")
    damp = 1.0 - reset
    ready = F.col("active") & F.col("salts").isNotNull() & (F.col("delta") > tol)
    sending = F.count_if(ready)
    try:
        e, seen = scratch.counted(valid_edges(nodes, edges).select("src", "dst"), "edges", edges=F.count(F.lit(1)))
        # no fewer buckets than shuffle partitions, or a join would deal them anew
        buckets = max(math.ceil(seen["edges"] / EDGES_PER_PARTITION),
                      int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        outdeg = scratch.table(
            e.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
             .withColumn("salts", F.ceil(F.col("out") / F.lit(EDGES_PER_PARTITION)).cast("int")), "outdeg")
        weighted = scratch.bucketed(
            e.join(outdeg, "src")
             .select("src", F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int").alias("salt"), "dst",
                     (F.lit(1.0) / F.col("out")).alias("w"))
             .repartition(buckets, "src", "salt"), "weighted", buckets, "src", "salt")
        scratch.drop("edges")

        # A vertex without out-edges (no salts) never sends; knowing that ends the
        # loop one round earlier on acyclic graphs.
        state, seen = scratch.counted(
            nodes.select("node_id")
                 .join(outdeg.select(F.col("src").alias("node_id"), "salts"), "node_id", "left")
                 .select("node_id", F.lit(reset).alias("pr"), F.lit(reset).alias("delta"),
                         F.lit(True).alias("active"), "salts"), "state-0", sending=sending)
        rounds = 0
        while seen["sending"]:
            if max_iter is not None and rounds >= max_iter:
                raise RuntimeError(f"PageRank has not converged after {rounds} rounds")
            rounds += 1
            state, seen = scratch.counted(_round(state, weighted, ready, damp), f"state-{rounds}", sending=sending)
            scratch.drop(f"state-{rounds - 1}")
    except BaseException:
        scratch.clear()
        raise
    scratch.drop("outdeg", "weighted")

    total = state.agg(F.sum("pr").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    scaled = state.join(F.broadcast(total), how="inner").select(
        "node_id", (F.col("pr") * (F.col("_n") / F.col("_sum"))).alias("pagerank"))
    return scaled.join(nodes, "node_id").select("node_type", "node_id", "pagerank")


def _round(state: DataFrame, weighted: DataFrame, ready: F.Column, damp: float) -> DataFrame:
    """The next state: messages of the vertices that can send, along the edges."""
    senders = state.where(ready).select(F.col("node_id").alias("src"), "delta",
                                        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    msgs = (weighted.join(senders.hint("merge"), ["src", "salt"])
                    .groupBy(F.col("dst").alias("node_id"))
                    .agg(F.sum(F.col("delta") * F.col("w")).alias("_msg")))
    got = F.col("_msg").isNotNull()
    new_pr = F.col("pr") + F.lit(damp) * F.col("_msg")
    return state.join(msgs, "node_id", "left").select(
        "node_id",
        F.when(got, new_pr).otherwise(F.col("pr")).alias("pr"),
        F.when(got, new_pr - F.col("pr")).otherwise(F.col("delta")).alias("delta"),
        got.alias("active"),
        "salts",
    )


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """undirected components; the label is the smallest ``node_id`` of the
    component (stable, unlike positional ids). Large-star/small-star rounds grow
    with the logarithm of the graph, not with its diameter."""
    scratch = Scratch(nodes.sparkSession, "components")
    roots = star_components(valid_edges(nodes, edges), scratch).withColumnRenamed("node", "node_id")
    return nodes.join(roots, "node_id", "left").select(
        F.coalesce("component", "node_id").alias("component_id"), "node_type", "node_id")


def component_sizes(components: DataFrame) -> DataFrame:
    """F10."""
    return components.groupBy("component_id").agg(F.count(F.lit(1)).alias("node_count"))


def _normalised(value: str, max_col: str) -> F.Column:
    return F.when(F.col(max_col) > 0, F.col(value).cast("double") / F.col(max_col) * 100.0) \
            .otherwise(F.lit(0.0))


def node_criticality(pr: DataFrame, deg: DataFrame) -> DataFrame:
    """40% degree share + 60% PageRank share of the maxima (inner join)."""
    w_deg, w_pr = K.CRITICALITY_WEIGHTS
    both = pr.join(deg.withColumnRenamed("degree", "total_degree"), ["node_type", "node_id"])
    maxima = both.agg(F.max("total_degree").alias("_maxd"), F.max("pagerank").alias("_maxp"))
    scored = both.join(F.broadcast(maxima), how="inner").select(
        "node_type", "node_id", "pagerank", "total_degree",
        _normalised("total_degree", "_maxd").alias("degree_score"),
        _normalised("pagerank", "_maxp").alias("pagerank_score"),
    )
    return scored.select(
        "*", F.round(F.col("degree_score") * w_deg + F.col("pagerank_score") * w_pr, 2)
              .alias("criticality_score")
    ).select("*", risk_level(F.col("criticality_score")).alias("criticality_level"))


def top_by_type(df: DataFrame, score: str, n: int = K.TOP_BY_TYPE_N,
                types=K.TOP_BY_TYPE_TYPES) -> DataFrame:
    """Top-n per node type, one bounded top-k per (fixed) type."""
    parts = [df.where(F.col("node_type") == t)
               .orderBy(F.col(score).desc_nulls_last(), F.col("node_id"))
               .limit(n) for t in types]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def edge_criticality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """the valid edges with their transaction counts (the listing's data)."""
    return valid_edges(nodes, edges).select("src", "dst", "relationship", "transaction_count",
                                            "avg_delivery_delay")


def top_critical_edges(nodes: DataFrame, edges: DataFrame, n: int = K.TOP_EDGES_N) -> DataFrame:
    """the n valid edges with the most transactions, ids as tie-breakers."""
    ranked = [F.col("transaction_count").desc_nulls_last(), *[F.col(c) for c in ("src", "dst", "relationship")]]
    return edge_criticality(nodes, edges).orderBy(*ranked).limit(n)


def _retention_level(col) -> F.Column:
    return at_least(col, K.RETENTION_CUTS, K.RETENTION_LABELS, K.RETENTION_ELSE)


def _impact(affected: F.Column) -> list[F.Column]:
    """The measures of a removal beside total_edges and remaining_vertices."""
    total, remaining = F.col("total_edges"), F.col("total_edges") - affected
    score = F.when(total > 0, remaining / total * 100.0).otherwise(F.lit(100.0))
    return [affected.alias("affected_edges"), "total_edges",
            F.when(total > 0, affected / total * 100.0).otherwise(F.lit(0.0)).alias("affected_percentage"),
            "remaining_vertices", remaining.alias("remaining_edges"), score.alias("resilience_score"),
            _retention_level(score).alias("resilience_level")]


def _affected() -> F.Column:
    """Valid edges that go with a node: a self-loop is one edge."""
    return F.col("in_degree") + F.col("out_degree") - F.col("self_loops")


def removal_impact_from(incident: DataFrame, ranked: DataFrame, score: str) -> DataFrame:
    """F14-F18 from the degree table: the node's counts are looked up, the edges
    are not read again."""
    top = (ranked.orderBy(F.col(score).desc_nulls_last(), F.col("node_type"), F.col("node_id"))
                 .limit(1)
                 .select(F.col("node_id").alias("failed_node_id"),
                         F.col("node_type").alias("failed_node_type"),
                         F.col(score).alias(score)))
    failed = F.col("node_id") == F.col("failed_node_id")
    row = (incident.join(F.broadcast(top), how="inner")
           .groupBy("failed_node_id", "failed_node_type", score)
           .agg(F.coalesce(F.sum(F.when(failed, _affected())), F.lit(0)).cast("long").alias("_affected"),
                F.sum("out_degree").alias("total_edges"), F.count_if(~failed).alias("remaining_vertices")))
    return row.select("failed_node_id", "failed_node_type", score, *_impact(F.col("_affected")))


def removal_impact(nodes: DataFrame, edges: DataFrame, ranked: DataFrame, score: str) -> DataFrame:
    """Remove the top node of ``ranked`` by ``score`` (ties by type, id)
    and measure affected edges, what remains and the retention resilience."""
    return removal_impact_from(_incident(nodes, edges), ranked, score)


def removal_impact_all_from(incident: DataFrame) -> DataFrame:
    """F19 from the degree table; the totals are one row."""
    totals = incident.agg(F.sum("out_degree").alias("total_edges"), (F.count(F.lit(1)) - 1).alias("remaining_vertices"))
    return incident.join(F.broadcast(totals), how="inner").select(
        F.col("node_id").alias("failed_node_id"), F.col("node_type").alias("failed_node_type"), *_impact(_affected()))


def removal_impact_all(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """removal impact of every node in one pass.

    affected = incident valid edges (a self-loop counted once).
    """
    return removal_impact_all_from(_incident(nodes, edges))
