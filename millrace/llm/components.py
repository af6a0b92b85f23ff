"""Connected components over links held in a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (src, dst: long); component is the smallest node reachable.

    Large-star and small-star rounds: each lets every node point its neighbours at the smallest one it
    knows, until nothing changes (about log2 of the longest path many rounds).  Each round is written
    to the shared folder, so lineage stays short and a lost executor costs one round at most.  Minima
    are taken map-side first; nothing but two numbers a round reaches the driver.
    Links of a node to itself are ignored; an empty table gives an empty table.
    """
    up = F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    edges = staged(links.select(*up).where("u != v").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = staged(_small_star(_large_star(edges)), "links")
        last, state = state, _state(edges)
        if state == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").union(least.select("u", F.col("m").alias("v"))).distinct()


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links a[i] - b[i]."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while True:  # point straight at the end of each chain
            jump = root[root]
            if (jump == root).all():
                break
            root = jump
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root
