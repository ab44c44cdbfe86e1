"""Connected components of links between long ids."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.session import settled


def spanning(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the labels of the ends of each link in one task; a label is the first position."""
    while True:
        one, two = labels[a], labels[b]
        apart = one != two
        if not apart.any():
            return labels
        low, high = np.minimum(one, two)[apart], np.maximum(one, two)[apart]
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is one node of the component.

    In each round a node goes to the smallest node among itself and its neighbours, and on to that
    one's choice; then the links are contracted to the chosen nodes. Every round is a written table,
    rounds follow until no link is left, and the rounds are put together from the last to the first.
    All steps are joins and partial aggregations, so neither a node with many links nor a large
    component has to fit into one task.
    """
    links = settled(links.where("a != b").distinct(), "links")
    rounds = []
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("next")).unionAll(
            links.select("b", "a"))
        chosen = settled(both.groupBy("node").agg(
            F.least("node", F.min("next")).alias("root")), "chosen")
        further = chosen.select(F.col("node").alias("root"), F.col("root").alias("over"))
        jumped = settled(chosen.join(further, "root").select(
            "node", F.col("over").alias("root")), "rounds")
        rounds.append(jumped)
        ends = links
        for end in ("a", "b"):
            ends = ends.join(jumped.withColumnsRenamed({"node": end, "root": f"root_{end}"}), end)
        links = settled(
            ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .where("a != b").distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds.pop()
    while rounds:
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("last"))
        roots = rounds.pop().join(later, "root", "left").select(
            "node", F.coalesce("last", "root").alias("root"))
    return roots
