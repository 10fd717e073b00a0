"""Exact nearest neighbours of many queries: the queries go round in bounded blocks, the table is never moved."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors broadcast at a time.
BLOCK = 4096


def _best(shared, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        kept_d, kept_i = np.full((len(q), 0), np.inf), np.zeros((len(q), 0), np.int64)
        for batch in batches:
            vectors = batch.column("vector")
            keep = [i for i, v in enumerate(vectors.to_pylist()) if v is not None and len(v) == q.shape[1] and None not in v]
            if not keep:
                continue
            x = np.array(vectors.take(pa.array(keep)).to_pylist(), np.float64)
            own = batch.column("id").take(pa.array(keep)).to_numpy()
            for at in range(0, len(x), 1024):
                d = ((q[:, None, :] - x[None, at : at + 1024, :]) ** 2).sum(axis=2) if len(q) <= 64 else np.stack([((one - x[at : at + 1024]) ** 2).sum(axis=1) for one in q])
                d = np.concatenate([kept_d, d], axis=1)
                i = np.concatenate([kept_i, np.broadcast_to(own[at : at + 1024], (len(q), d.shape[1] - kept_i.shape[1]))], axis=1)
                order = np.lexsort((i, d), axis=1)[:, :k]
                kept_d, kept_i = np.take_along_axis(d, order, 1), np.take_along_axis(i, order, 1)
        n = kept_d.shape[1]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(kept_i.ravel()), pa.array(kept_d.ravel())], ["query", "id", "_distance"])

    return run


def nearest(table: DataFrame, vector_col: str, id_col: str, queries: DataFrame, query_col: str, query_id: str, k: int = 10) -> DataFrame:
    """The k rows nearest to each query by squared distance: query_id, id_col, _distance, rank; ties by id.

    Queries come to the driver BLOCK at a time and are broadcast; each task keeps k rows a query, which one shuffle by query
    ranks. Ids are whole numbers. Null vectors, vectors with nulls and of another length are not found and ask nothing.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    out, block = None, []

    def add(found, block):
        sizes = {len(v) for _, v in block}
        for size in sorted(sizes):
            own = [(i, v) for i, v in block if len(v) == size]
            shared = spark.sparkContext.broadcast((np.array([i for i, _ in own], np.int64), np.array([v for _, v in own], np.float64)))
            part = rows.mapInArrow(_best(shared, k, pa.int64()), "query long, id long, _distance double")
            found = part if found is None else found.union(part)
        return found

    for r in queries.select(query_id, query_col).toLocalIterator():
        if r[0] is not None and r[1] and None not in r[1]:
            block.append((r[0], list(r[1])))
        if len(block) == BLOCK:
            out, block = add(out, block), []
    out = add(out, block) if block else out
    out = out if out is not None else spark.createDataFrame([], "query long, id long, _distance double")
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("_distance", "id")).cast("long")).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_id), F.col("id").alias(id_col), "_distance", "rank")


#: Products of a query and a row held at a time.
PRODUCTS = 1 << 22


def _matrix(column: pa.ChunkedArray) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """By length: the places of the vectors without nulls, and the vectors."""
    vectors = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).copy()
    holes = np.unique(pc.list_parent_indices(vectors).to_numpy()[pc.list_flatten(vectors).is_null().to_numpy(zero_copy_only=False)])
    lengths[holes] = -1
    at = {int(n): np.flatnonzero(lengths == n) for n in np.unique(lengths) if n >= 0}
    return at, {n: pc.list_flatten(vectors.take(pa.array(i))).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(i), n) for n, i in at.items()}


def _sum(terms) -> np.ndarray:
    """In order, as Spark's aggregate adds them, so that distances are the same to the last bit."""
    total = 0.0
    for t in terms:
        total = total + t
    return total


def _exact(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    if metric == "l2":
        return _sum((x[:, i] - q[:, i]) * (x[:, i] - q[:, i]) for i in range(x.shape[1])) + np.zeros(len(x))
    product = lambda a, b: _sum(a[:, i] * b[:, i] for i in range(a.shape[1])) + np.zeros(len(a))
    return 1 - product(x, q) / (np.sqrt(product(x, x)) * np.sqrt(product(q, q)) if metric == "cosine" else 1)


def nearest_in_cell(k: int, metric: str):
    """Rows (_id, _v) and queries (_query, _q) -> the k nearest rows of each query, ties by id. Products of matrices tell which
    rows can be among them, within a bound of their rounding; those are measured again as Spark measures a single pair."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows["_id"], null_placement="at_start"))
        out = [], [], []
        with np.errstate(all="ignore"):
            (row_at, x_of), (query_at, q_of) = _matrix(rows["_v"]), _matrix(queries["_q"])
            for n in row_at.keys() & query_at.keys():
                x, q, own, asked = x_of[n], q_of[n], row_at[n], query_at[n]
                if metric == "cosine":
                    some_x, some_q = (x != 0).any(axis=1), (q != 0).any(axis=1)
                    x, q, own, asked = x[some_x], q[some_q], own[some_x], asked[some_q]
                xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
                step = max(1, PRODUCTS // max(1, len(x)))
                for a in range(0, len(q) if len(x) else 0, step):
                    y, yy = q[a : a + step], qq[a : a + step, None]
                    d, off = y @ x.T, (n + 8) * 1e-15
                    if metric == "l2":
                        d, off = xx + yy - 2 * d, off * (xx.max() + yy)
                    elif metric == "cosine":
                        d = 1 - d / np.sqrt(xx * yy)
                    else:
                        d, off = 1 - d, off * (1 + np.sqrt(xx.max() * yy))
                    most = np.partition(d, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1, None] + 2 * off
                    one, other = np.nonzero(~(d > most))
                    for s in range(0, len(one), 1 << 16):
                        i, j = one[s : s + (1 << 16)], other[s : s + (1 << 16)]
                        for to, what in zip(out, (asked[a + i], own[j], _exact(x[j], y[i], metric)), strict=True):
                            to.append(what)
        query, row, d = (np.concatenate(o) if o else np.zeros(0, t) for o, t in zip(out, (np.int64, np.int64, np.float64), strict=True))
        order = np.lexsort((row, d, query))
        query, row, d = query[order], row[order], d[order]
        first = np.searchsorted(query, query, side="left")
        few = np.arange(len(query)) - first < k
        return pa.table([queries["_query"].take(pa.array(query[few])), rows["_id"].take(pa.array(row[few])), pa.array(d[few])], names=["_query", "_id", "_distance"])

    return run
