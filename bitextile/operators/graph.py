"""Graphs: chains of parents, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import release, written


def roots(links: DataFrame, most: int = 64, cut: bool = False) -> DataFrame:
    """id and root of each node; links: id, parent (null for a root). Parents that are no ids end a chain unfound and
    their nodes are left out. Pointer doubling: the number of rounds is the logarithm of the longest chain.

    A cycle is an error; with `cut` each of its nodes is its own root, and what leads to it has the node where it enters.
    """
    ids = links.select("id")
    at = written(links.select("id", F.coalesce("parent", "id").alias("to")).join(ids.withColumnRenamed("id", "to"), "to", "left_semi"), "roots")
    held = at
    rounds = min(most, max(1, at.count()).bit_length() + 1)  # by then every chain has ended
    for _ in range(rounds):
        up = at.select(F.col("id").alias("to"), F.col("to").alias("next"))
        new = written(at.join(up, "to").select("id", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "roots")
        release(held)
        held = new
        if not new.where("moved").limit(1).count():
            break
        at = new.select("id", "to")
    on = held.select(F.col("to").alias("id")).distinct().join(links.where("parent IS NOT NULL AND parent <> id").select("id"), "id", "left_semi")
    if not on.limit(1).count():
        return held.select("id", F.col("to").alias("root"))
    if not cut:
        raise ValueError("the links have a cycle or are too long")
    on = written(on.withColumn("cycle", F.lit(True)), "cycles")  # what is left to point at lies on cycles
    release(held)
    free = links.join(on, "id", "left").select("id", F.when(F.col("cycle").isNull(), F.col("parent")).alias("parent"))
    return roots(free, most)


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of an undirected graph with edges a, b."""
    two = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(two.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    held = labels
    while True:
        near = two.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        least = labels.join(near, "node").select("node", F.least("component", "m").alias("c"), F.col("component").alias("old"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("next"))
        new = written(least.join(jump, "c", "left").select("node", "old", F.least("c", "next").alias("component")), "labels")
        release(held)
        held = new
        if not new.where("component <> old").limit(1).count():
            release(two)
            return new.select("node", "component")
        labels = new.select("node", "component")
