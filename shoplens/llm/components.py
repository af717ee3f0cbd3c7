"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Each round sends every node to the least of itself and its neighbours, then to
    where that one was sent, and contracts the graph: edges run between the nodes
    arrived at, each once, and those within a node go.  So a node's many edges to nodes
    that are joined to it anyway are read once, not in every round.  The least node of a
    component is never sent away, and a node arrived at keeps an edge to where it was
    sent itself, so components stay whole.  Ends when no edge is left.  Joins on a hub's
    key are plain shuffles of both sides, which AQE can split.  Self loops, repeated edges
    and either direction are allowed; no edges give no rows.
    """
    left = stage(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "cc-edges")
    labels = None
    while labels is None or not left.isEmpty():
        both = left.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(left.select(F.col("b").alias("u"), F.col("a").alias("v")))
        sent = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), "cc-sent")
        on = sent.select(F.col("u").alias("q"), F.col("p").alias("far"))
        sent = stage(sent.join(on, sent.p == on.q).select("u", F.col("far").alias("p")), "cc-sent")
        if labels is None:
            labels = sent.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            labels = stage(labels.join(sent, labels.component == sent.u, "left").select("node", F.coalesce("p", "component").alias("component")),
                           "cc-labels")
        at, to = (sent.select(F.col("u").alias(f"{c}u"), F.col("p").alias(f"{c}p")) for c in "ab")
        left = stage(left.join(at, left.a == at.au).join(to, left.b == to.bu).filter("ap <> bp")
                     .select(F.least("ap", "bp").alias("a"), F.greatest("ap", "bp").alias("b")).distinct(), "cc-edges")
    return labels
