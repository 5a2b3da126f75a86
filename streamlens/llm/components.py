"""Connected components of an edge table, in Spark (alternating star contraction).

Each round links every larger neighbour of a node to the node's smallest
neighbour (large star), then every smaller neighbour and the node itself to the
smallest (small star).  The number of edges never grows, and chains shrink
geometrically.  Minima are pre-aggregated on the map side; the joins back have
one unique side, so a hot node is an ordinary skewed join that AQE splits.
Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import materialize, own_exchange


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n indexes over the links a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        before = root.copy()
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        if np.array_equal(root, before):
            return root


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge to another node; root is the
    smallest node of its component.  Self loops and NULLs are ignored."""
    cur = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(f"`{a}` is not null and `{b}` is not null and u > v").distinct(), "edges")
    state = _state(cur)
    while state[0]:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(own_exchange(low, "u"), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(own_exchange(low, "u"), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        cur = materialize(small, "edges")
        new = _state(cur)
        if new == state:
            break
        state = new
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
