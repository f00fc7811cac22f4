"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import stage


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of the edges but the least one of each component, which is the root."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, grown = np.minimum(root[one], root[other]), root.copy()
        np.minimum.at(grown, root[one], low)
        np.minimum.at(grown, root[other], low)
        while ((up := grown[grown]) != grown).any():
            grown = up
        if (grown == root).all():
            break
        root = grown
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _least(edges: DataFrame) -> DataFrame:
    """Per node a the least node m in reach, and whether a is open: neither a root nor a leaf of one."""
    low, high = F.min("b"), F.max("b")
    return edges.groupBy("a").agg(F.least(low, F.col("a")).alias("m"), ((low < F.col("a")) & (low < high)).alias("open"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the least node of its component.

    The edges are read several times and should be stored; the fewer steps from a node to its root (see ``stars``), the fewer rounds.
    In a round neighbours move to the least node in reach, first larger ones, then smaller ones; the rounds end when no node is open.
    The minima are written before they are joined: a node with very many neighbours is reduced by a partial minimum and joined to one
    row, and a join of plain tables is one that Spark can split at such a node.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(_least(both), "least")
        if least.where("open").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        large = both.join(least.select("a", "m"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large, "large")
        down = stage(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        near = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(near.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
