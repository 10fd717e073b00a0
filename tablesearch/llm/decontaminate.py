"""Benchmark decontamination: each passage of a text is a BM25 query against the test items; hits are verified word by word."""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, text_chunks

#: BM25's usual constants.
K1, B = 1.2, 0.75
#: Words of a passage and between the starts of two; items are indexed in parts of at most PASSAGE words, of which some
#: passage holds three quarters.
PASSAGE, STRIDE = 48, 24
#: A passage retrieves an item's part from this share of the part's score against itself on; under QUESTION, as half of the
#: runs may be less than half of the score.
RETRIEVE = 0.35
#: A document has an item if it holds this share of the question's and of the answer's word runs of up to RUN words; of an
#: item without a marked answer, of all its runs.
QUESTION, ANSWER, RUN = 0.5, 0.5, 4
#: Neighbouring parts share a block, which has one bound of a term's weights; there are at most BLOCKS.
BLOCK, BLOCKS = 4, 64
#: Words of a text whose bounds are held at a time.
SLICE = STRIDE * 4096
#: Text of test items in one index, about, and the indexes that are broadcast for one pass over the documents. Both set the
#: memory and the passes only: weights are those of the whole benchmark.
INDEX_BYTES, INDEXES = 4 << 20, 8
_WORDS = re.compile(r"[^\W_]+")
#: "Answer:" where a word starts; "A:" where a line or a sentence does.
_ANSWER = re.compile(r"(?is)^(.*?)(?:(?<![^\W_])answer|(?:^|[\n.!?])\s*a)\s*:\s*(.+)$")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and after "Answer:" or "A:"; of a text without such a mark all words are both."""
    m = _ANSWER.match(text)
    parts = (words_of(m[1]), words_of(m[2])) if m else ([], [])
    return parts if all(parts) else (words_of(text),) * 2


def runs(words: list[str]) -> set[tuple[str, ...]]:
    n = min(RUN, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Index:
    """Postings by term in ascending order of item parts, with a term's weight as a share of the part's own score."""

    items: list  # the id of each part's item
    runs: list[tuple[set, set]]  # of each part's item: of its question and of its answer
    terms: dict[str, int]
    postings: list[tuple[np.ndarray, np.ndarray]]  # by term: parts, weights; term 0 stands for all words not indexed
    bounds: np.ndarray  # by term and block: the largest weight
    block: int

    def search(self, terms: list[int], block: int, threshold: float) -> dict[int, float]:
        """The parts of a block whose score is threshold or more, by WAND: cursors are moved up to the first part whose terms
        can reach it by their bounds in this block."""
        low, high = block * self.block, (block + 1) * self.block
        lists = []
        for t in terms:
            if bound := float(self.bounds[t, block]):
                parts, weights = self.postings[t]
                lists.append([int(np.searchsorted(parts, low)), bound, parts, weights])
        found: dict[int, float] = {}
        at = lambda x: int(x[2][x[0]]) if x[0] < len(x[2]) else high
        while True:
            lists = sorted((x for x in lists if at(x) < high), key=at)
            total, pivot = 0.0, None
            for x in lists:
                total += x[1]
                if total >= threshold - 1e-6:
                    pivot = at(x)
                    break
            if pivot is None:
                return found
            score = 0.0
            for x in lists:
                if at(x) > pivot:
                    break
                x[0] += int(np.searchsorted(x[2][x[0] :], pivot))
                if at(x) == pivot:
                    score += float(x[3][x[0]])
                    x[0] += 1
            if score >= threshold - 1e-6:
                found[pivot] = score


def parts_of(words: list[str]) -> list[list[str]]:
    """An item's words in parts of at most PASSAGE, of about equal length."""
    size = -(-len(words) // max(1, -(-len(words) // PASSAGE)))
    return [words[i : i + size] for i in range(0, len(words), max(1, size))]


def build(items: list[tuple[int | None, str]], rare: dict[str, float], mean: float | None = None) -> Index:
    """items: (id, text). rare: the idf of each term over the whole benchmark, and mean: the words of a part there, whichever
    index the item is in."""
    parts = []
    for item, text in items:
        q, a = question_and_answer(text)
        parts += [(item, own, (runs(q), runs(a))) for own in parts_of(words_of(text))]
    mean = mean or sum(len(w) for _, w, _ in parts) / max(1, len(parts))
    lists: dict[str, list[tuple[int, float]]] = {}
    for n, (_, words, _) in enumerate(parts):
        weight = {t: rare[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(words) / mean)) for t, f in Counter(words).items()}
        own = sum(weight.values())
        for t, w in weight.items():
            lists.setdefault(t, []).append((n, w / own))
    terms = {t: i for i, t in enumerate(lists, 1)}
    postings = [(np.zeros(0, np.int64), np.zeros(0))] + [(np.array([n for n, _ in p]), np.array([w for _, w in p])) for p in lists.values()]
    block = max(BLOCK, -(-len(parts) // BLOCKS))
    bounds = np.zeros((len(postings), max(1, -(-len(parts) // block))), np.float32)
    for t, (n, w) in enumerate(postings):
        np.maximum.at(bounds[t], n // block, w.astype(np.float32))
    return Index([i for i, *_ in parts], [r for *_, r in parts], terms, postings, bounds, block)


def leaks_in(words: list[str], index: Index) -> list[tuple[int | None, float, float, float]]:
    """(item, best score, question overlap, answer overlap) of each item that a text of these words holds."""
    if not words:
        return []
    terms = np.fromiter(map(index.terms.get, words, repeat(0)), np.int64, len(words))
    # The bound of each passage in each block: repeats count, so it is never too low. Long texts go in slices.
    able = []
    for at in range(0, len(terms), SLICE):
        halves = np.add.reduceat(index.bounds[terms[at : at + SLICE + STRIDE]], np.arange(0, len(terms[at : at + SLICE + STRIDE]), STRIDE), axis=0)
        sums = halves[:-1] + halves[1:] if len(halves) > 1 else halves
        n, block = np.nonzero(sums >= RETRIEVE - 1e-4)
        able += zip((at + n * STRIDE).tolist(), block.tolist(), strict=True)
    best: dict[int, float] = {}
    last, distinct, own = None, None, None
    for start, block in able:
        if start != last:
            last, distinct = start, np.unique(terms[start : start + PASSAGE])
            own = index.bounds[distinct].sum(axis=0)
        if own[block] >= RETRIEVE - 1e-4:
            for part, score in index.search(distinct.tolist(), block, RETRIEVE).items():
                best[part] = max(best.get(part, 0.0), score)
    if not best:
        return []
    sizes = {len(next(iter(r))) for part in best for r in index.runs[part] if r}
    held = {tuple(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}
    out: dict[tuple, float] = {}
    for part, score in sorted(best.items()):
        q, a = (len(r & held) / len(r) for r in index.runs[part])
        if q >= QUESTION and a >= ANSWER:
            out[index.items[part], q, a] = max(score, out.get((index.items[part], q, a), 0.0))
    return [(item, score, q, a) for (item, q, a), score in out.items()]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items -> a row for each distinct word with its shard, and one (word null) for the item with its parts and their words."""
    for batch, texts in text_chunks(batches, "text"):
        for shard, text in zip(batch.column("shard").to_pylist(), texts, strict=True):
            words = words_of(text)
            own = [None, *set(words)]
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(own), pa.int64()), pa.array(own, pa.string()), pa.array([len(parts_of(words)), *[0] * (len(own) - 1)], pa.int64()), pa.array([len(words), *[0] * (len(own) - 1)], pa.int64())], ["shard", "word", "parts", "words"])


def _build(total: int, mean: float):
    """A shard's items, and its words with the number of the benchmark's items that hold each -> its index."""

    def run(key: tuple[pa.Scalar, ...], items: pa.Table, words: pa.Table) -> pa.Table:
        if not items.num_rows:
            return pa.table({"shard": pa.array([], pa.int64()), "index": pa.array([], pa.binary())})
        rare = _Idf(dict(zip(words.column("word").to_pylist(), words.column("n").to_pylist(), strict=True)), total)
        index = build(sorted(zip(items.column("number").to_pylist(), items.column("text").to_pylist(), strict=True)), rare, mean)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "index": pa.array([pickle.dumps(index)], pa.binary())})

    return run


class _Idf(dict):
    def __init__(self, df: dict[str, int], total: int):
        super().__init__({t: math.log(1 + (total - n + 0.5) / (n + 0.5)) for t, n in df.items()})


def _indexes(benchmark: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, list[tuple]]:
    """The distinct items with a number each, and broadcasts of at most INDEXES of their indexes each.

    Items are dealt to shards by a hash of their number; words are counted over all of them by Spark; each shard's index is
    built in a task and written. The driver holds the indexes of one broadcast at a time."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    items = cut(rows.select(F.monotonically_increasing_id().alias("number"), "item", "text"), "items")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = -(-size // INDEX_BYTES)
    if not shards:
        return items, []
    dealt = items.select(F.pmod(F.xxhash64("number"), F.lit(shards)).alias("shard"), "number", "text")
    words = cut(dealt.select("shard", "text").mapInArrow(_item_words, "shard long, word string, parts long, words long"), "words")
    stats = words.filter("word is null").agg(F.count("*").alias("items"), F.sum("parts").alias("parts"), F.sum("words").alias("words")).first()
    if not stats["parts"]:
        return items, []
    counts = words.filter("word is not null").groupBy("word").agg(F.count("*").alias("n"))
    known = words.select("shard", "word").distinct().join(counts, "word").select("shard", "word", "n")
    build_ = _build(stats["items"], stats["words"] / stats["parts"])
    built = cut(dealt.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(build_, "shard long, index binary"), "indexes")
    numbers = sorted(r["shard"] for r in built.select("shard").collect())
    groups = [numbers[i : i + INDEXES] for i in range(0, len(numbers), INDEXES)]
    return items, [spark.sparkContext.broadcast([pickle.loads(r["index"]) for r in built.filter(F.col("shard").isin(g)).collect()]) for g in groups]


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for batch, texts in text_chunks(batches, "text"):
            rows = [(n, *hit) for n, words in enumerate(map(words_of, texts)) for index in indexes for hit in leaks_in(words, index)]
            if rows:
                at, items, scores, q, a = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), pa.array(items, pa.int64()), pa.array(scores), pa.array(q), pa.array(a)], ["id", "number", "score", "question_overlap", "answer_overlap"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Test items that documents hold: id_col, item_col, score, question_overlap, answer_overlap; a row for each pair.

    Every passage of every whole text is searched; an item's score is BM25 as a share of the item's score against itself,
    with the frequencies and the mean length of the whole benchmark. The indexes of the benchmark's shards are built in tasks
    and broadcast, INDEXES at a time; the documents are read once for each such group. Texts are not shuffled.

    Null texts and texts without words hold nothing and are held by nothing. A pair is listed for each row of a document
    and each distinct row of an item. Ids of both may be of any type. Empty tables give no pairs. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, number long, score double, question_overlap double, answer_overlap double"
    items, groups = _indexes(benchmark, item_col, item_text_col)
    out = spark.createDataFrame([], schema)
    for n, shared in enumerate(groups):
        found = base.mapInArrow(_find(shared), schema)
        out = out.union(found) if n else found
    out = out.join(items.select("number", "item"), "number").select("id", "item", "score", "question_overlap", "answer_overlap")
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def _clean(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for batch, texts in text_chunks(batches, text_col):
            yield batch.filter(pa.array([not any(leaks_in(words, index) for index in indexes) for words in map(words_of, texts)]))

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no test item, with all their columns; rows as find_leaks judges them."""
    out = docs
    for shared in _indexes(benchmark, item_col, item_text_col)[1]:
        out = out.mapInArrow(_clean(shared, text_col), docs.schema)
    return out
