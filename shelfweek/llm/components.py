"""Connected components of a distributed list of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import settle


class Forest:
    """Groups of 0 to n - 1 within a task, joined by arrays of links; each hangs on its
    smallest member, so that a group is handed on with a row for each other member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[i], root[j]
            apart = x != y
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            x, y = x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := root[root], root):
                root[:] = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        hung = np.flatnonzero(self.root != np.arange(len(self.root)))
        return hung, self.root[hung]


def _towards_smallest(links: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest of itself and its neighbours ``v``, beside every link.

    The join goes by the hash of the node and not by the node itself: its sides are then dealt
    anew, and adaptive execution can split the links of a node with very many."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("_u"), F.xxhash64("u").alias("_k"), F.least("u", "m").alias("m"))
    same = (F.xxhash64(links["u"]) == F.col("_k")) & (links["u"] == F.col("_u"))
    return links.join(least, same).drop("_u", "_k")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has a link.

    Alternates two steps until nothing changes: each node hangs its larger neighbours on
    its smallest one, then its smaller neighbours and itself. Rounds grow with the
    logarithm of the number of nodes. Smallest neighbours are partial aggregates, and a node
    with very many links is split in the joins. Links to itself and links with a null end count for nothing.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    links = links.where(f"{a} <> {b}").select(u, v).distinct()
    links, seen = settle(links), None
    while True:
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if state == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct()
            )
        seen = state
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_smallest(both).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _towards_smallest(large)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        roots = large.groupBy("u").agg(F.min("v").alias("v"))
        links = settle(small.union(roots).distinct())
