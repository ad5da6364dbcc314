"""Distributed connected components by alternating large-star and small-star steps.

Each step joins the edges with the smallest neighbour of each node. Sums and
minima are combined before they are shuffled, and the joins leave their sides
to adaptive execution, which splits the partition of a hub. Every round is
written to the shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.session import forget, persist



def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest
    node. ``edges`` has longs ``u`` and ``v``; loops and repeats do no harm."""
    current = persist(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    state = _state(current)
    while state[0]:
        # Large star: every larger neighbour of a node moves to its smallest neighbour.
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v")))).distinct()
        after = persist(small, "components")
        new = _state(after)
        done = new == state
        forget(current)
        current, state = after, new
        if done:
            break
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(members.select(F.col("component").alias("node"), "component").distinct())


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row reachable by the links (a[i], b[i])."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
