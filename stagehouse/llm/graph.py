"""Connected components by contraction, for links that Spark holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to ``node``, ``component``: the smallest node reachable.

    Every round maps each node to the smallest among itself and its neighbours
    and replaces links by links between those; nodes at least halve in each
    component, and the smallest node stays. Both steps combine on the map side,
    and each round is a table in the shared folder. Nodes without links are left
    out. Null ends are ignored.
    """
    edges = links.where("a <> b").select("a", "b").distinct()
    edges = materialize(edges, "links")
    placed: DataFrame | None = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("least")), "least"
        )
        if placed is None:
            placed = least.withColumnRenamed("least", "component")
        else:
            step = least.withColumnRenamed("node", "component")
            placed = placed.join(step, "component", "left").select(
                "node", F.coalesce("least", "component").alias("component")
            )
            placed = materialize(placed, "placed")
        to_a = least.select(F.col("node").alias("a"), F.col("least").alias("na"))
        to_b = least.select(F.col("node").alias("b"), F.col("least").alias("nb"))
        moved = edges.join(to_a, "a").join(to_b, "b").where("na <> nb")
        edges = materialize(
            moved.select(F.greatest("na", "nb").alias("a"), F.least("na", "nb").alias("b")).distinct(), "links"
        )
        if edges.isEmpty():
            return placed


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes by the given links, within a task."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (before == root).all():
            break
        open_links = root[a] != root[b]
        a, b = a[open_links], b[open_links]
    while True:
        deeper = root[root]
        if (deeper == root).all():
            return root
        root = deeper
