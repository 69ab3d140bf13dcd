"""Connected components of an edge table, in rounds over written tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of ``edges`` (``a``, ``b``, long, not null).

    Each round hangs every node's larger neighbours on its smallest one and then every node's smaller neighbours on
    the smallest of them, so paths shorten by a factor and a node with very many neighbours is one partial aggregate.
    Rounds end when all edges point at a root. No edge reaches the driver.
    """
    spread = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    current = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(current):
        both = current.select(spread.alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = cut_lineage(large, "large-star")
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        small = large.join(parent, "a").select(pairs.alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        current = cut_lineage(small, "small-star")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _settled(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, and that is nobody's larger end."""
    out = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    into = edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    each = out.unionByName(into).groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return each.where("out > 1 or (out = 1 and into = 1)").isEmpty()


def spanning_forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places among the edges (a, b) of those that make a spanning forest."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(ends[: len(a)].tolist(), ends[len(a) :].tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(kept, np.int64)
