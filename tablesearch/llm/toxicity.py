"""Toxicity by compression distance: windows are compressed with a dictionary of ordinary and one of toxic text."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fold, text_chunks

#: Bounds of the fit: labelled rows of each class that it reads, by hash. CALIBRATION of them set the thresholds only.
SAMPLE_TOXIC, SAMPLE_ORDINARY, CALIBRATION = 10_000, 20_000, 0.3
#: A word leans to toxic rows if it is in MIN_ROWS distinct ones, RATIO times as common as in ordinary rows, and so clearly
#: that of all words tested about one would be by chance; at most MAX_WORDS do, the clearest.
MIN_ROWS, RATIO, MAX_WORDS = 5, 10, 2000
#: The toxic dictionary is trained on the windows of toxic rows that a leaning word and its neighbours make, to WORD_BYTES for
#: each leaning word; the ordinary one on windows of ordinary rows, to ORDINARY_BYTES. For each, at most TRAIN windows (the
#: least hashes, at most WINDOW_BYTES of each) come to the driver; ordinary ones from about ORDINARY_ROWS rows.
WORD_BYTES, ORDINARY_BYTES, TRAIN, WINDOW_BYTES, ORDINARY_ROWS = 16, 60_000, 40_000, 200, 3000
#: Words of a window that is scored, and zstandard's level.
WINDOW, LEVEL = 16, 6
_LETTERS = regex.compile(r"\p{L}+")


@dataclass(frozen=True)
class Model:
    """ordinary: the dictionary trained on ordinary windows. toxic: the one trained on toxic windows, before those same
    bytes, so a window's two lengths differ by what the toxic one saves beyond the ordinary one and by nothing else. Both are
    used as raw content, without the trainer's entropy tables, which would differ. weights: of the features; mean and spread:
    of the features in the fit."""

    ordinary: bytes
    toxic: bytes
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]


def windows(text: str) -> list[bytes]:
    words = text.lower().encode().split()
    return [b" ".join(words[i : i + WINDOW]) for i in range(0, len(words), WINDOW)]


@lru_cache(maxsize=4)
def _compressors(ordinary: bytes, toxic: bytes):
    def one(content: bytes):
        if not content:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False).compress

    return one(ordinary), one(toxic)


def features(text: str, ordinary: bytes, toxic: bytes) -> list[float]:
    """Of the bytes that the toxic dictionary saves in each window: the most, the sum of the three most, the logarithm of the
    sum of what is over one byte, that sum by the root of the windows, and the logarithm of the number of windows."""
    plain, other = _compressors(ordinary, toxic)
    saved = sorted((len(plain(w)) - len(other(w)) for w in windows(text)), reverse=True) or [0]
    over = float(sum(s for s in saved if s > 1))
    return [float(saved[0]), float(sum(saved[:3])), float(np.log1p(over)), over / len(saved) ** 0.5, float(np.log(len(saved)))]


def _shingled(seed: int):
    """Adds the least hash of a text's five-word runs: near copies mostly have the same, other texts do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            words = (t.lower().encode().split() for t in texts)
            least = [min(xxhash.xxh64_intdigest(b" ".join(w[i : i + 5]), seed) for i in range(max(1, len(w) - 4))) >> 1 for w in words]
            yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("toxic"), pa.array(least, pa.int64())], ["text", "toxic", "least"])

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_chunks(batches, "text"):
        toxic, all_rows = Counter(), Counter()
        for label, text in zip(batch.column("toxic").to_pylist(), texts, strict=True):
            words = set(_LETTERS.findall(text.lower()))
            all_rows.update(words)
            if label:
                toxic.update(words)
        yield pa.RecordBatch.from_arrays([pa.array(list(all_rows), pa.string()), pa.array([toxic[w] for w in all_rows], pa.int64()), pa.array([n - toxic[w] for w, n in all_rows.items()], pa.int64())], ["word", "toxic", "ordinary"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in text_chunks(batches, "text"):
        yield _hashed([w for t in texts for w in windows(t)])


def _around(leaning: frozenset[str]):
    """The windows that a word with a run of letters in leaning makes with the word before and the word after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches, "text"):
            found = []
            for words in (t.lower().split() for t in texts):
                at = [i for i, w in enumerate(words) if not leaning.isdisjoint(_LETTERS.findall(w))]
                found += [" ".join(words[max(0, i - 1) : i + 2]).encode() for i in at]
            yield _hashed(found)

    return run


def _hashed(found: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([zlib.crc32(w) for w in found], pa.int64()), pa.array([w[:WINDOW_BYTES] for w in found], pa.binary())], ["hash", "window"])


def _trained(found: DataFrame, size: int) -> bytes:
    """zstandard's dictionary of the windows found (hash, window), repeats included; where they are too few for its trainer,
    the windows themselves."""
    pieces = [bytes(r["window"]) for r in found.orderBy("hash", "window").limit(TRAIN).collect()]
    try:
        return zstandard.train_dictionary(max(size, 512), pieces).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(pieces)[:size]


def _features(ordinary: bytes, toxic: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([features(t, ordinary, toxic) for t in texts], pa.list_(pa.float64()))], ["toxic", "features"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w += np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(len(w)), a.T @ (y - p) - 0.05 * w)
    return mean, spread, w


def fit(labelled: DataFrame) -> Model:
    """Learn from rows with text and toxic (0 or 1); a null label teaches nothing, a null text counts as empty.

    Word counts are Spark aggregations over the sampled rows, where copies of a text count once. To the driver come at most
    MAX_WORDS words, TRAIN windows for each dictionary and five numbers for each calibration row. With rows of one class
    only, every score is that class's share, smoothed.
    """
    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") == 1).cast("int").alias("toxic")).filter("toxic is not null").distinct().persist()
    split = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1000)) < int(1000 * CALIBRATION)
    try:
        sizes = {(r["toxic"], r["check"]): r["n"] for r in rows.groupBy("toxic", split.alias("check")).agg(F.count("*").alias("n")).collect()}
        n_toxic, n_ordinary = (sum(n for (toxic, _), n in sizes.items() if toxic == label) for label in (1, 0))
        if not n_toxic or not n_ordinary:
            share = (n_toxic + 0.5) / (n_toxic + n_ordinary + 1)
            odds = float(np.log(share / (1 - share))) if n_toxic + n_ordinary else -1.0
            return Model(b"", b"", (0.0,) * 5, (1.0,) * 5, (odds, *(0.0,) * 5))
        # Words are counted in the dictionary's rows; where there are few, or all of a class are in one part (the copies of a
        # text are), all rows serve both purposes.
        few = n_toxic < 60 or len(sizes) < 4
        learn, check = (rows, rows) if few else (rows.filter(~split), rows.filter(split))
        # The rows of near copies are no evidence of their own: one of each counts.
        apart = learn
        for seed in (1, 2):
            apart = apart.mapInArrow(_shingled(seed), "text string, toxic int, least long").groupBy("toxic", "least").agg(F.min("text").alias("text")).select("text", "toxic")
        apart = apart.persist()
        sizes = {r["toxic"]: r["n"] for r in apart.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n_toxic, n_ordinary = sizes[1], sizes[0]
        counts = apart.mapInArrow(_words, "word string, toxic long, ordinary long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
        # exp(-clear) bounds the chance of so many toxic rows among a word's rows (Chernoff) were toxic rows like any others.
        n, share = F.col("toxic") + F.col("ordinary"), n_toxic / (n_toxic + n_ordinary)
        part = lambda k, p: F.when(k > 0, k * F.log(k / n / p)).otherwise(0.0)
        tested = counts.filter(F.col("toxic") >= min(MIN_ROWS, n_toxic)).withColumn("clear", part(F.col("toxic"), share) + part(F.col("ordinary"), 1 - share)).persist()
        marked = tested.filter((F.col("clear") >= float(np.log(max(1, tested.count())))) & (F.col("toxic") / n_toxic >= RATIO * (F.col("ordinary") + 0.5) / n_ordinary))
        words = [r["word"] for r in marked.orderBy(F.desc("clear"), "word").limit(MAX_WORDS).collect()]
        tested.unpersist()
        toxic = _trained(apart.filter("toxic = 1").select("text").mapInArrow(_around(frozenset(words)), "hash long, window binary"), WORD_BYTES * len(words)) if words else b""
        apart.unpersist()
        rate = int((1 << 32) * min(1.0, ORDINARY_ROWS / n_ordinary))
        plain = learn.filter((F.col("toxic") == 0) & (F.pmod(F.xxhash64("text", F.lit(2)), F.lit(1 << 32)) < rate)).select("text").mapInArrow(_windows, "hash long, window binary")
        ordinary = _trained(plain, ORDINARY_BYTES)
        toxic += ordinary
        found = check.mapInArrow(_features(ordinary, toxic), "toxic int, features array<double>").collect()
    finally:
        rows.unpersist()
    mean, spread, weights = _logistic(np.array([r["features"] for r in found]).reshape(len(found), 5), np.array([float(r["toxic"]) for r in found]))
    return Model(ordinary, toxic, tuple(mean.tolist()), tuple(spread.tolist()), tuple(weights.tolist()))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mean, spread, weights = np.array(m.mean), np.array(m.spread), np.array(m.weights)
        for batch, texts in text_chunks(batches, "text"):
            x = np.array([features(t, m.ordinary, m.toxic) for t in texts])
            score = 1 / (1 + np.exp(-np.clip(weights[0] + ((x - mean) / spread) @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Toxicity of each whole text: id_col, score (0 to 1), predicted (1 if score is 0.5 or more).

    A null text counts as empty, whose windows save nothing. Each input row gives one row; ids may be null or repeat; other
    columns are ignored; an empty table gives an empty table.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = base.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), f"id {base.schema['id'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def sampled(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """text and toxic of at most about SAMPLE_TOXIC and SAMPLE_ORDINARY labelled documents, chosen by a hash of their id."""
    rows = labels.filter(allowed & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    sizes = {bool(r["toxic"]): r["n"] for r in rows.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    rate = lambda label, most: F.lit(int((1 << 32) * min(1.0, most / max(1, sizes.get(label, 0)))))
    picked = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < F.when(F.col("toxic") == 1, rate(True, SAMPLE_TOXIC)).otherwise(rate(False, SAMPLE_ORDINARY)))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")  # the sample's size is bounded above


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo 5 is 0), score, predicted; learnt from labels of rows not held out."""
    held = fold("doc_id", 5) == 0
    model = fit(sampled(docs, labels, ~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
