"""Groups of rows that are linked, directly or over others, and the row that stands for each group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.operators.events import union_all

Store = Callable[[DataFrame, str], DataFrame]


def shared_value_links(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Links (a, b) between rows that share a value: each to the smallest key with that value.

    A value that many rows have gives one link per row, not one per pair. Nulls link nothing.
    """
    out = []
    for c in columns:
        rows = df.select(F.col(key).alias("b"), F.col(c).alias("_v")).where("_v is not null and b is not null")
        least = rows.groupBy("_v").agg(F.min("b").alias("a"))
        out.append(rows.join(least, "_v").where("a <> b").select("a", "b"))
    return union_all(out).distinct()


def components(links: DataFrame, store: Store) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a and b): the root is the component's smallest node.

    Each round points every node to its smallest neighbour if that is smaller, follows the
    pointers to their ends by doubling, and replaces the links by links between ends. Two
    rounds at least halve a component's nodes. Neighbours are reduced to their minimum
    before anything is joined, and each round's tables are stored.
    """
    edges = store(links.where("a <> b and a is not null and b is not null").select("a", "b").distinct(), "links")
    roots = store(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "roots")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        up = store(both.groupBy("a").agg(F.min("b").alias("to")).where(F.col("to") < F.col("a")), "pointers")
        while True:
            far = up.select(F.col("a").alias("to"), F.col("to").alias("_far"))
            longer = store(up.join(far, "to", "left").select("a", F.coalesce("_far", "to").alias("to"), F.col("_far").isNotNull().alias("_moved")), "pointers")
            up = longer.select("a", "to")
            if longer.where("_moved").isEmpty():
                break
        ends = {c: up.select(F.col("a").alias(c), F.col("to").alias(f"_{c}")) for c in ("a", "b", "root")}
        moved = edges.join(ends["a"], "a", "left").join(ends["b"], "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        roots = store(roots.join(ends["root"], "root", "left").select("node", F.coalesce("_root", "root").alias("root")), "roots")
        edges = store(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return roots


def survivors(df: DataFrame, key: str, groups: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``_root`` (its group; the row's own key where it has none) and ``_survivor``: the key of
    the group's first row by ``order``, then by key."""
    named = df.join(groups.select(F.col("node").alias(key), F.col("root").alias("_root")), key, "left")
    named = named.withColumn("_root", F.coalesce("_root", F.col(key)))
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(key).alias("key"))
    best = named.groupBy("_root").agg(F.min(rank)["key"].alias("_survivor"))
    return named.join(best, "_root")
