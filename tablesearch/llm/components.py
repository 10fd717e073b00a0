"""Connected components of a link table, as Spark joins and aggregations (alternating large-star and small-star steps)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from each node but one of every connected group to that one: fewer links than given, joining the same nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while (root[left] != root[right]).any():
        low = root.copy()
        np.minimum.at(low, root[left], root[right])
        np.minimum.at(low, root[right], root[left])
        root = low[root]
        while (root[root] != root).any():
            root = root[root]
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]


def spanning(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the links (a, b) make a spanning forest of least weight; ties go to the earlier link."""
    at = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    left, right = at[: len(a)], at[len(a) :]
    rank = np.empty(len(a), np.int64)
    rank[np.argsort(weight, kind="stable")] = np.arange(len(a))
    root, links, taken = np.arange(len(at)), np.arange(len(a)), np.zeros(len(a), bool)
    while True:
        links = links[root[left[links]] != root[right[links]]]
        if not len(links):
            return np.flatnonzero(taken)
        u, v, r = root[left[links]], root[right[links]], rank[links]
        best = np.full(len(root), len(a))
        np.minimum.at(best, u, r)
        np.minimum.at(best, v, r)
        first, second = best[u] == r, best[v] == r  # the lightest link of either end
        taken[links[first | second]] = True
        to = np.arange(len(root))
        to[u[first]] = v[first]
        to[v[second]] = u[second]
        low = (to[to] == np.arange(len(root))) & (np.arange(len(root)) < to)  # of two that point at each other one is the root
        to[low] = np.flatnonzero(low)
        while (to[to] != to).any():
            to = to[to]
        root = to[root]


#: Rows of two longs that Spark may broadcast if it likes. It goes by the size of compressed files, of which columns of ids
#: are a small part of what they are in memory, so larger tables are kept off the driver.
MOST_SENT = 200_000


def joinable(df: DataFrame, rows: int) -> DataFrame:
    """df, of at most so many rows, as one side of a join: not broadcast where it may be large."""
    return df if rows <= MOST_SENT else df.hint("merge")


def _large_star(e: DataFrame, rows: int) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(joinable(low, 2 * rows), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame, rows: int) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(joinable(low, rows), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node reachable from each linked node: columns node, component.

    links: two long columns, any direction, repeats and self links allowed; rows with a null end link nothing.
    Nodes without a link to another are not returned. Every round is written to the shared folder, so lost executors
    cost at most one round; only two numbers a round come to the driver.
    """
    e = cut(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v").distinct(), "links")
    seen, rows = None, e.count()
    while True:
        e = cut(_small_star(_large_star(e, rows), 2 * rows), "stars")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == now:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen, rows = now, now["n"]
