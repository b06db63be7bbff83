"""Connected components as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.sources.store import ParquetStore


def connected_components(edges: DataFrame, store: ParquetStore, name: str = "components", most_rounds: int | None = None) -> DataFrame:
    """``node, component`` for every node of the undirected ``edges`` (a, b); two nodes are connected
    exactly if they have the same component, which is one of its nodes.

    Each round moves every node to the least of its neighbours in an order drawn anew, and edges follow
    their ends; ends that meet drop out.  In a random order a round removes a constant share of the
    nodes that still have edges, also along a path, so that rounds grow with the logarithm of the
    input.  With ``most_rounds`` it stops early: nodes of one component are connected then, but not the
    other way round.  Every round is written, which cuts the lineage.  A node with very many edges is folded
    before it is shuffled, and adaptive execution splits it in the joins.  Edges with a null end or
    with equal ends are left out.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    rounds, spent = [], []
    while True:
        step = len(rounds)
        spent.append(f"{name}-edges-{step}")
        if step == most_rounds and rounds:
            break
        current = store.keep(spent[-1], edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if current.isEmpty():
            break

        def ranked(node: str, step: int = step) -> Column:
            # The first order is that of plain hashes: stars around nodes chosen by it fall together at once.
            rank = F.xxhash64(F.col(node), F.lit(step)) if step else F.xxhash64(F.col(node))
            return F.struct(rank.alias("rank"), F.col(node).alias("node"))

        ends = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(ranked("b")).alias("other"))
        moved = least.select(F.col("a").alias("node"), F.least(F.col("other"), ranked("a"))["node"].alias("parent"))
        spent.append(f"{name}-moves-{step}")
        moved = store.keep(spent[-1], moved)
        rounds.append(moved)
        left = moved.select(F.col("node").alias("a"), F.col("parent").alias("to_a"))
        right = moved.select(F.col("node").alias("b"), F.col("parent").alias("to_b"))
        edges = current.join(left, "a").join(right, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).filter("a <> b")
    if not rounds:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[-1].select("node", F.col("parent").alias("component"))
    for moved in reversed(rounds[:-1]):
        above = labels.select(F.col("node").alias("parent"), "component")
        labels = moved.join(above, "parent", "left").select("node", F.coalesce("component", "parent").alias("component"))
    result = store.keep(name, labels)
    store.remove(spent)
    return result
