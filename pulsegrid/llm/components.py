"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pulsegrid.session import cut


def block_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest node linked, over any number of steps, with each of ``n`` nodes in memory."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a long, b long)``, in any order and repeated.

    The component is the smallest node. Large-star and small-star rounds in turn: every node's
    larger neighbours move to its smallest neighbour, until each component is a star. A round is
    written to the shared folder, so a lost executor repeats one round at most. A hub costs no
    task more than its share: minima are pre-aggregated, and the joins may be split by key.
    Links with a null end or from a node to itself are ignored.
    """
    a, b = F.col("a"), F.col("b")
    pairs = links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    current = cut(pairs.distinct())
    signature = None
    while True:
        found = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if found == signature or not found[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select("b", "b").distinct()
            )
        signature = found
        both = current.union(current.select("b", "a"))
        # Written, so that the join with it can be split where a hub holds many links.
        lowest = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        large = both.filter(b > a).join(lowest, "a").select(b.alias("a"), F.col("low").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(least, "a").filter(b != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        current = cut(least.withColumnRenamed("low", "b").union(moved).distinct())
