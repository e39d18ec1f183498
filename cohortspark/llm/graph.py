"""Connected components of a distributed list of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch


def components(edges: DataFrame, work: Scratch) -> DataFrame:
    """node and root (least node of its component) for every node of ``edges`` (a, b) that is no root.

    Alternating stars: each node hands its least neighbour to its larger neighbours, then to its
    smaller ones, until every component is one star. Neighbours are never gathered: a node's least
    neighbour is an aggregate, written and then joined back to the edges, so that adaptive execution
    can split a hub (it splits no join that stands on an aggregate). Each round's edges are written.
    """
    now = work.keep(
        edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct()
    )
    while True:
        both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).union(now.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = work.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        large = work.keep(large)
        best = work.keep(large.groupBy("high").agg(F.min("low").alias("m")))
        small = large.join(best, "high").where("low <> m").select(F.col("m"), F.col("low").alias("high"))
        new = work.keep(small.union(best.select("m", "high")).distinct().toDF("low", "high"))
        # done if all larger ends hang on one node each that hangs on none
        twice = new.groupBy("high").count().where("count > 1").limit(1).count()
        chained = 0 if twice else new.join(new.select(F.col("high").alias("low")), "low", "left_semi").limit(1).count()
        work.drop(now, large, least, best)
        now = new
        if not twice and not chained:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root"))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of the component of each of ``n`` nodes under edges between ``a`` and ``b``."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        while (jump := root[root]).tobytes() != root.tobytes():
            root = jump
        if np.array_equal(before, root):
            break
    return root
