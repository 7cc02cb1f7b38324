"""Connected components of link tables, distributed.

Alternating star steps on the edges: every node hands its smallest neighbour
to its larger ones, then to its smaller ones, until each component is a star
around its smallest node. A node's minimum is found by partial aggregation and
joined back, so a hub with any number of links is split like any skewed join.
Edges are cut to a table each round; only a change count reaches the driver.
``union`` does the same inside one task, on arrays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditpulse.llm.common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; root is the smallest node reachable.

    Self-links and repeated links are fine; an empty table gives an empty result.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
              "edges")
    before = None
    for _ in range(max_rounds):
        both = now.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
                                            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("p"))
        both = both.select("p.u", "p.v")
        # Larger neighbours of u go to the smallest one around u.
        least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("m", F.least("u", "least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # Smaller neighbours of a node, and the node itself, go to its smallest one.
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(root, "hi")
                 .select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                                           F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")))).alias("p"))
                 .select("p.hi", "p.lo").where("hi > lo").distinct())
        now = cut(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.groupBy("hi").agg(F.min("lo").alias("root")).select(F.col("hi").alias("node"), "root")
    return stars.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def flatten(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a[i]`` and ``b[i]``; ``parent`` is flat before and after."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = flatten(parent)
