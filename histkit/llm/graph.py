"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b, longs); the root is the
    component's smallest node.

    Alternates large-star and small-star steps: each links a node's neighbours to the smallest
    of them, and the number of rounds grows with the logarithm of a component's size. Minima
    are aggregated before they are joined back, so a node with very many links is no group.
    """
    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("w")).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = store(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct())


def local_components(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable node of each of ``n`` nodes, within one task."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while not np.array_equal(new, hop := new[new]):
            new = hop
        if np.array_equal(new, root):
            return root
        root = new
