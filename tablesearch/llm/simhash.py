"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed.

near_duplicates links documents whose fingerprints of word shingles are near. keep_one_each, which links documents whose sets
of shingles are similar, is in similar.py.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, text_chunks
from .components import components, spanning
from .similar import keep_one_each  # noqa: F401

BITS = 64
#: Fingerprints of one table key that meet in one task at a time; a larger key is compared in pairs of blocks of this size.
BLOCK = 2048


def covering_masks(radius: int, bits: int = BITS, seed: int = 7) -> list[int]:
    """2**(radius+1) - 1 bit masks of which, for any radius positions, one contains none of them.

    Each position gets a vector over GF(2) of radius+1 digits; mask v has the positions whose vector is not orthogonal to v.
    At most radius vectors leave some v != 0 orthogonal to all of them. The vectors are dealt evenly, so masks keep about
    half of the bits each.
    """
    size = 1 << radius + 1
    vectors = [i % size for i in range(bits)]
    random.Random(seed).shuffle(vectors)
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size)]


def fingerprint(words: list[bytes], size: int) -> int:
    """Words are lower-cased already. Bits set in over half of the hashes of all shingles, repeats included."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = [h(text[a:b], 42) for a, b in zip(starts, ends[size - 1 :])] if len(words) >= size else [h(text, 42)]
    counts = np.zeros(BITS, np.int64)
    values = np.array(hashes, ">u8")
    for i in range(0, len(values), 1 << 15):
        counts += np.unpackbits(values[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(values)).tobytes(), "big")


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            words = (t.encode().lower().split() for t in texts)
            prints = np.array([fingerprint(w, size) for w in words], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(prints.view(np.int64))], ["id", "key", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """id, key (a hash of the text) and fp (the 64 fingerprint bits as a long) of each whole text.

    A-Z are lower-cased, words are split at ASCII white space, a shingle is shingle_words words joined by a space, hashed by
    XXH64 with seed 42. Fewer words: the whole sequence is the one shingle. A null text and one without words have 0.
    """
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    return base.mapInArrow(_fingerprints(shingle_words), f"id {base.schema['id'].dataType.simpleString()}, key long, fp long")


def _near(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= radius


def _links(radius: int):
    """Rows sorted by (table, key, left, right): fingerprints that share a key. A key of one block has left = right = 0;
    of a larger one the pairs of its blocks are dealt out as keys of their own. Gives links (pairs within the radius) enough
    to join what is near: all of a small key, a spanning forest of the nearest of a large one."""

    def group(node: np.ndarray, fp: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, w, held = [], [], [], 0
        rows, columns = (np.flatnonzero(side < 0), np.flatnonzero(side > 0)) if side.any() else (np.arange(len(fp)),) * 2
        for i in rows.tolist():
            others = columns if side.any() else columns[i + 1 :]
            apart = np.bitwise_count(fp[others].view(np.uint64) ^ fp[i : i + 1].view(np.uint64))
            near = np.flatnonzero(apart <= radius)
            if len(near):
                a.append(np.full(len(near), i))
                b.append(others[near])
                w.append(apart[near])
                held += len(near)
            if held > 1 << 20:
                a, b, w = ([np.concatenate(x)] for x in (a, b, w))
                few = spanning(a[0], b[0], w[0])
                a, b, w, held = [a[0][few]], [b[0][few]], [w[0][few]], len(few)
        if not a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b, w = (np.concatenate(x) for x in (a, b, w))
        few = spanning(a, b, w)
        return node[a[few]], node[b[few]]

    def small(key: np.ndarray, node: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of few rows, all at once: each row against the next, the one after, ..."""
        a, b = [], []
        for d in range(1, most):
            same = np.flatnonzero(key[d:] == key[:-d])
            if not len(same):
                break
            same = same[_near(fp[same], fp[same + d], radius)]
            a.append(node[same])
            b.append(node[same + d])
        return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        rest = None
        for batch in batches:
            now = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("table", "key", "left", "right", "side", "node", "fp")]) if batch.num_rows else None
            if now is None:
                continue
            now = now if rest is None else np.concatenate([rest, now], axis=1)
            new = np.flatnonzero((now[:4, 1:] != now[:4, :-1]).any(axis=0)) + 1
            if not len(new):
                rest = now
                continue
            yield from (out(*x) for x in complete(now[:, : new[-1]], new[:-1]))
            rest = now[:, new[-1] :].copy()
        if rest is not None:
            new = np.flatnonzero((rest[:4, 1:] != rest[:4, :-1]).any(axis=0)) + 1
            yield from (out(*x) for x in complete(rest, new))

    def complete(rows: np.ndarray, new: np.ndarray):
        edges = np.concatenate([[0], new, [rows.shape[1]]])
        sizes = np.diff(edges)
        number = np.repeat(np.arange(len(sizes)), sizes)
        few = (sizes <= 32)[number]
        if few.any():
            a, b = small(number[few], rows[5][few], rows[6][few], 33)
            if len(a):
                yield a, b
        for i in np.flatnonzero(sizes > 32):
            own = slice(edges[i], edges[i + 1])
            a, b = group(rows[5, own], rows[6, own], rows[4, own])
            if len(a):
                yield a, b

    return run


def near_fingerprints(prints: DataFrame, radius: int = 3, node_col: str = "fp") -> DataFrame:
    """Links (a, b; a < b) among the distinct longs of node_col, each with a fingerprint fp, that join exactly those whose
    fingerprints are within radius bits of each other. The same link may come more than once.

    Every row goes to one key a mask; rows that share a key with no other are dropped there. Small keys are compared
    within a task. A key of more than BLOCK rows is cut into blocks by a hash, and each pair of blocks is a key of its own,
    so that no task grows with a key. A task gives a spanning forest of the near pairs of a large key, never all pairs.
    """
    masks = F.array(*[F.lit(m - (1 << BITS) if m >> BITS - 1 else m) for m in covering_masks(radius)])
    keyed = prints.select(F.col(node_col).alias("node"), "fp", F.posexplode(masks).alias("table", "mask")).select(F.col("table").cast("long").alias("table"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "node", "fp")
    shared = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(shared, ["table", "key"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    many = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(F.least(j, F.col("block")).alias("left"), F.greatest(j, F.col("block")).alias("right"), F.when(j == F.col("block"), F.lit(0)).when(F.col("block") < j, F.lit(-1)).otherwise(F.lit(1)).cast("long").alias("side")))
    dealt = met.withColumn("block", block).select("table", "key", "node", "fp", F.explode(many).alias("p")).select("table", "key", "p.left", "p.right", "p.side", "node", "fp")
    dealt = dealt.repartition("table", "key", "left", "right").sortWithinPartitions("table", "key", "left", "right")
    return dealt.mapInArrow(_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """Documents linked by fingerprints of radius or fewer differing bits: id_col, fingerprint (16 hex digits), component_id
    (the smallest id reachable by links, its own included) and kept (it is that id).

    Equal fingerprints are one node, so copies cost nothing but their fingerprint. A null or word-free text has fingerprint
    zero and links like any other. A null id is never the smallest unless its group has no other; kept is then true. Rows
    with equal ids each give a row. An empty table gives an empty table; other columns are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle_words), "prints")
    nodes = cut(prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("low")), "nodes")
    found = components(near_fingerprints(nodes, radius))
    whole = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    groups = whole.select("fp", "component").join(whole.groupBy("component").agg(F.min("low").alias("first")), "component").select("fp", "first.id")
    out = prints.join(groups.select("fp", F.col("id").alias("component_id")), "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
