"""Embedding near-duplicates: int8 tile products whose error is bounded vector by vector, exact where the bound leaves doubt."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut
from .components import components, forest

#: Vectors of a cell's side (a task's memory holds two sides), and of a tile within it.
SIDE, TILE = 8192, 1024


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values q, scales s, |s q| and |x - s q| of unit vectors x, one row each."""
    scale = np.abs(units).max(axis=1) / 127.0
    q = np.rint(units / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(units - back, axis=1)


def _tile(a, b, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b whose cosine is threshold or more; a and b: (vectors scaled near one, unit vectors, int8 values as float32, scale,
    length, error).

    With x = s q + e the product of two unit vectors differs from s s' (q q') by at most |e| |s'q'| + |sq| |e'| + |e| |e'|.
    int8 products are whole numbers below 2**24 up to 1040 dimensions, so float32 matrix products have them exactly;
    wider vectors use float64.
    """
    approximate = (a[2] @ b[2].T) * a[3][:, None] * b[3][None, :]
    bound = a[5][:, None] * (b[4] + b[5])[None, :] + a[4][:, None] * b[5][None, :]
    i, j = np.nonzero(approximate + bound >= threshold - 1e-6)
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        x, y = a[0][i[at : at + (1 << 16)]], b[0][j[at : at + (1 << 16)]]
        keep[at : at + (1 << 16)] = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))) >= threshold
    return i[keep], j[keep]


def _side(vectors: np.ndarray):
    # Scaled by a power of two first, so that no component over- or underflows and all digits stay.
    near_one = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    units = near_one / np.linalg.norm(near_one, axis=1, keepdims=True)
    q, scale, length, error = quantise(units)
    kind = np.float32 if vectors.shape[1] <= 1040 else np.float64
    return near_one, units, q.astype(kind), scale.astype(kind), length.astype(kind), error.astype(kind)


def _cell(threshold: float):
    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """One cell: rows (node, copies, side, vector) -> rows (node, links) and (a, b), the links of a spanning forest."""
        nodes, copies, side = (table.column(c).to_numpy() for c in ("node", "copies", "side"))
        flat = table.column("vector").combine_chunks()
        vectors = flat.values.to_numpy(zero_copy_only=False).reshape(len(nodes), -1).astype(np.float64)
        same = key[1].as_py() == key[2].as_py()
        left, right = (np.arange(len(nodes)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        links = np.zeros(len(nodes), np.int64)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = [x[at : at + TILE] for x in (left, right) for at in range(0, len(x), TILE)]
        half = -(-len(left) // TILE)
        sides = [_side(vectors[p]) for p in parts[: half if same else None]]
        for m in range(half):
            for n in range(m, half) if same else range(half, len(parts)):
                i, j = _tile(sides[m], sides[n], threshold)
                i, j = parts[m][i], parts[n][j]
                if same and m == n:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    links += np.bincount(i, copies[j], len(nodes)).astype(np.int64) + np.bincount(j, copies[i], len(nodes)).astype(np.int64)
                    a, b = forest(np.concatenate([a, nodes[i]]), np.concatenate([b, nodes[j]]))
        has = links > 0
        return pa.table({"node": pa.array(np.concatenate([nodes[has], a])), "links": pa.array(np.concatenate([links[has], np.zeros(len(a), np.int64)])), "other": pa.array(np.concatenate([nodes[has], b]))})

    return compare


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, side: int = SIDE) -> DataFrame:
    """Vectors linked by a cosine of threshold or more (double precision): id_col, n_links (other rows linked directly),
    component_id (the smallest id reachable, its own included), kept (it is that id).

    Equal vectors are one node that carries its number of rows. Nodes are dealt into G groups of about `side`; each pair of
    groups is one task's cell, so every node is sent G times and no task holds more than two groups. A cell gives a count of
    links for each node and a spanning forest of its links, never the links themselves.

    The work grows with the square of the distinct vectors: all are compared with all, as the operation asks. Vectors that
    are null, empty, all zero or hold null or non-finite components link with nothing and are components of their own, as
    are vectors of another length than those they meet. A null id counts as a row and as a link, but is the smallest only
    where its group has no other. Rows with equal ids each give a row. An empty table gives an empty table.
    """
    # Single-precision vectors travel as such and become double in the tasks.
    kind = "array<float>" if table.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    good = F.size("vector") > 0
    good &= ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    # -0.0 and 0.0 are one value; rows of equal vectors share a group key.
    rows = rows.withColumn("vector", F.when(good, F.transform("vector", lambda x: F.when(x == 0, F.lit(0).cast(kind[6:-1])).otherwise(x))))
    name = F.struct(F.xxhash64("vector").alias("one"), F.xxhash64(F.lit(1), "vector").alias("two"))  # 128 bits
    valid = rows.filter("vector is not null").groupBy("vector").agg(F.count("*").alias("copies"), F.min("id").alias("low"))
    # Numbers are given as the table is written, so they are unique and stay.
    nodes = cut(valid.select(F.monotonically_increasing_id().alias("node"), name.alias("name"), "copies", "low", F.size("vector").alias("dim"), "vector"), "vectors")
    total = nodes.count()
    groups = max(1, math.ceil(total / side))
    mine = F.pmod(F.hash("node"), F.lit(groups))
    cells = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda j: F.struct(F.least(j, F.col("group")).alias("left"), F.greatest(j, F.col("group")).alias("right"), (j < F.col("group")).cast("int").alias("side")))
    dealt = nodes.withColumn("group", mine).select("node", "copies", "dim", "vector", F.explode(cells).alias("c")).select("node", "copies", "vector", "dim", "c.left", "c.right", "c.side")
    found = cut(dealt.groupBy("dim", "left", "right").applyInArrow(_cell(threshold), "node long, links long, other long"), "cells")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.filter("node <> other"), "node", "other")
    named = nodes.select("node", "name", "copies", "low").join(linked, "node", "left").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select("name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id")
    keyed = rows.select("id", F.when(F.col("vector").isNotNull(), name).alias("name"))
    out = keyed.join(named, "name", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
