"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.frames import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b: any one orderable type, not null).

    component names one node of the component, the same for all its nodes; which
    one is arbitrary. Each round every node joins its neighbour of least random
    rank, if that is less than its own, and links are drawn between the nodes
    joined, so that a constant share of the nodes that still have links vanishes,
    whatever the graph's shape: a chain takes no more rounds than a star. Ranks
    change from round to round. Each round's tables are written to the shared
    folder. Minima are combined before the shuffle and both joins meet a table of
    unique nodes, so a hub with a third of all links is split like any skewed join.
    """
    edges = materialize(links.where("a <> b").select("a", "b").distinct(), "links")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        step = materialize(_nearest(edges, len(steps)), "roots")
        edges = materialize(_contracted(edges, step), "links")
        steps.append(step)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    out = steps[0].select("node", F.col("root").alias("component"))
    for step in steps[1:]:
        below = step.select(F.col("node").alias("component"), F.col("root").alias("_root"))
        out = out.join(below, "component", "left").select("node", F.coalesce("_root", "component").alias("component"))
    return out


def _rank(node: Column, turn: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(turn)).alias("rank"), node.alias("node"))


def _nearest(edges: DataFrame, turn: int) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    least = both.groupBy("node").agg(F.min(_rank(F.col("other"), turn)).alias("best"))
    return least.select("node", F.least("best", _rank(F.col("node"), turn))["node"].alias("root"))


def _contracted(edges: DataFrame, step: DataFrame) -> DataFrame:
    left = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
    right = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
    drawn = edges.join(left, "a").join(right, "b").where("x <> y")
    return drawn.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[k] and b[k]; root names the least node of each tree."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]
