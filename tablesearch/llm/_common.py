"""Shared pieces: bounded text chunks inside tasks, folds, and tables that cut lineage in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text held as Python objects at a time in a worker. A longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


_own: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; where it is unset, one of a session that is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        key = spark.sparkContext.applicationId
        folder = _own[key] = _own.get(key) or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return folder.rstrip("/")


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: the rows outlive lost executors and the lineage ends here."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, buckets: int) -> Column:
    """crc32 of the id's decimal text, modulo buckets; an id of null counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(buckets)


def chunks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have at most max_bytes together, or are one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, n = 0, batch.num_rows
        while start < n:
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """chunks with their texts as Python strings; null is ''."""
    for batch in chunks(batches, column, max_bytes):
        yield batch, ["" if t is None else t for t in batch.column(column).to_pylist()]


class Codes(dict):
    """Dense numbers for keys in order of first sight: codes[key] adds what is missing."""

    def __missing__(self, key):
        self[key] = code = len(self)
        return code

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class Pieces:
    """A worker's growing table from piece to id array, emptied when it is full, so its memory is bounded.

    encode(list of new pieces) gives their ids end to end and the number of ids of each. ids_of() gives the ids of a
    sequence of pieces.
    """

    def __init__(self, encode, max_pieces: int = 600_000):
        self.encode, self.max_pieces = encode, max_pieces
        self.clear()

    def clear(self) -> None:
        self.codes, self.known = Codes(), 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def ids_of(self, pieces: list, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces[code] for all codes, end to end, and the number of ids of each."""
        if len(self.codes) > self.max_pieces:
            self.clear()
        own = self.codes.of(pieces)
        if len(self.codes) > self.known:
            self._learn()
        own = own[codes]
        lengths = self.length[own]
        ends = np.cumsum(lengths)
        where = np.repeat(self.start[own] - (ends - lengths), lengths)
        where += np.arange(len(where))
        return self.flat[where], lengths

    def _learn(self) -> None:
        new = list(self.codes)[self.known :] if not self.known else [k for k, _ in zip(reversed(self.codes), range(len(self.codes) - self.known))][::-1]
        flat, lengths = self.encode(new)
        n, used = len(self.codes), self.used + len(flat)
        if n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros(max(len(x), n - len(x)), np.int64)]) for x in (self.start, self.length))
        if used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), used - len(self.flat)), np.uint32)])
        self.flat[self.used : used] = flat
        self.length[self.known : n] = lengths
        self.start[self.known : n] = self.used + np.cumsum(lengths) - lengths
        self.known, self.used = n, used
