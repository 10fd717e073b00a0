"""Byte-level BPE encoding and decoding by merge replay over the corpus's distinct words."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Codes, Pieces, cut, text_chunks
from .words import PRE_TOKEN, Splitter, count_words, most_frequent

#: The most frequent words of the corpus that are broadcast with their ids (some 15 MB in a worker). Words beyond them are
#: replayed where they are met.
HOT_WORDS = 200_000
#: Stretches of text whose ids a task remembers.
REMEMBERED = 400_000
#: Bytes of words that are replayed at a time; longer words are replayed one by one.
REPLAY_BYTES, LONG = 4 << 20, 256
#: Ranks of a band of the index (a power of two) and the rank of what does not merge.
BAND, NONE = 12, np.int32(0x7FFFFFFF)


class PairRanks:
    """From two token ids to the id they merge to, for arrays: an open hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        keys, values = np.array(list(found), np.uint64), np.array(list(found.values()), np.int32)
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask, self.free = np.uint64(64 - bits), np.int64((1 << bits) - 1), np.uint64(0xFFFFFFFFFFFFFFFF)
        self.keys, self.values = np.full(1 << bits, self.free), np.full(1 << bits, NONE)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            self.keys[at[todo]] = np.where(self.keys[at[todo]] == self.free, keys[todo], self.keys[at[todo]])
            placed = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[placed]]] = values[todo[placed]]
            todo = todo[~placed]
            at[todo] = at[todo] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of the pairs; NONE where they do not merge or a or b is no token."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], NONE)
        open_ = np.flatnonzero((there != keys) & (there != self.free))
        while len(open_):
            at[open_] = at[open_] + 1 & self.mask
            there = self.keys[at[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.values[at[open_[same]]]
            open_ = open_[~same & (there != self.free)]
        return out


class MergeReplay:
    """Applies the merges of a rank file to many words at once.

    An inverted index leads from the rank of a token pair to the positions of its left halves in all words. Ranks are taken
    in order; each merge touches its two neighbours only, whose new pairs go into the index. The index is kept in bands of
    ranks: of the lowest band, each word has the merges of its lowest rank applied, all words together; words share no
    position, so the order among them does not matter.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairRanks(ranks)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        both = np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256)
        self.first = self.pairs.get(self.byte[both[0]], self.byte[both[1]]).reshape(256, 256)  # of each two bytes
        size = max(ranks.values()) + 1
        token = [b""] * size
        for b, i in ranks.items():
            token[i] = b
        self.token_bytes = np.frombuffer(b"".join(token), np.uint8)
        self.token_size = np.fromiter(map(len, token), np.int64, size)
        self.token_at = np.cumsum(self.token_size) - self.token_size

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids end to end, and where each id's bytes end."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.token_size) or not self.token_size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.token_size[ids]
        ends = np.cumsum(sizes)
        where = np.repeat(self.token_at[ids] - (ends - sizes), sizes)
        where += np.arange(len(where))
        return self.token_bytes[where].tobytes(), ends

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        ids, lengths = self.replay(words)
        return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] if words else []

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and their number for each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int32, len(words))  # a word that is a token is never split
        parts: list = [None] * len(words)
        short = np.flatnonzero((whole < 0) & (sizes > 0) & (sizes <= LONG))
        lengths = (whole >= 0).astype(np.int64)
        long = [(i, self._alone(words[i])) for i in np.flatnonzero((whole < 0) & (sizes > LONG)).tolist()]
        for i, ids in long:
            lengths[i] = len(ids)
        ends, at, replayed = np.cumsum(sizes[short] + 1), 0, []
        while at < len(short):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + REPLAY_BYTES, side="right")))
            own = short[at:stop]
            ids, lengths[own] = self._together([words[i] for i in own.tolist()], sizes[own])
            replayed.append((own, ids))
            at = stop
        starts = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), np.uint32)
        out[starts[whole >= 0]] = whole[whole >= 0]
        for i, ids in long:
            out[starts[i] : starts[i] + len(ids)] = ids
        for own, ids in replayed:
            n = lengths[own]
            where = np.repeat(starts[own] - (np.cumsum(n) - n), n)
            out[where + np.arange(len(ids))] = ids
        return out, lengths

    def _together(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # All words end to end, with -1 after each; a position stands for the token that starts there.
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        n, ends = len(data), np.cumsum(sizes + 1) - 1
        symbols, rank = self.byte[data], np.full(n, NONE)
        rank[:-1] = self.first[data[:-1], data[1:]]
        symbols[ends] = -1
        rank[ends] = rank[ends - 1] = NONE
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes + 1)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[-1] = before[0] = n - 1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(places: np.ndarray) -> None:
            bands = rank[places] >> BAND
            for band in np.flatnonzero(np.bincount(bands)).tolist():
                if band not in index:
                    heappush(heap, band)
                    index[band] = []
                index[band].append(places[bands == band])

        add(np.flatnonzero(rank < NONE).astype(np.int32))
        while heap:
            band = heappop(heap)
            places = np.concatenate(index.pop(band))
            places = np.sort(places[rank[places] >> BAND == band])  # the other pairs are merged or changed
            places = places[np.concatenate([places[:1] >= 0, places[1:] != places[:-1]])]
            if not len(places):
                continue
            own, ranks = word[places], rank[places]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            counts = np.diff(np.append(first, len(places)))
            now = ranks == np.repeat(np.minimum.reduceat(ranks, first), counts)
            at, rest = places[now], places[~now]
            again = np.concatenate([[False], word[at[1:]] == word[at[:-1]]])
            if again.any():
                several = again | np.append(again[1:], False)
                go, wait = self._in_order(at[several], again[several], symbols, after, before, rank, word)
                at, rest = np.concatenate([at[~several], go]), np.concatenate([rest, wait])
            merged, gone = rank[at], after[at]
            right = after[gone]
            symbols[at], symbols[gone], rank[gone] = merged, -2, NONE
            after[at], before[right] = right, at
            near = np.concatenate([at, before[at]])
            near = near[symbols[near] >= 0]
            rank[near] = self.pairs.get(symbols[near], symbols[after[near]])
            add(np.concatenate([near[rank[near] < NONE], rest[rank[rest] < NONE]]))
        left = symbols >= 0
        return symbols[left].astype(np.uint32), np.bincount(word[left], minlength=len(words))

    def _in_order(self, at, again, symbols, after, before, rank, word) -> tuple[np.ndarray, np.ndarray]:
        """Of several merges of one rank in a word: those to apply now, and those to look at again afterwards. They go from left to
        right: of overlapping ones every second, and only a word's first if a pair of a lower rank can come of it."""
        merged = rank[at]
        lower = np.minimum(np.minimum(self.pairs.get(symbols[before[at]], merged), self.pairs.get(merged, symbols[after[after[at]]])), self.pairs.get(merged, merged)) < merged
        touch = np.concatenate([[False], after[at[:-1]] == at[1:]])
        place = np.arange(len(at))
        odd = (place - np.maximum.accumulate(np.where(touch, 0, place))) % 2 == 1
        keep = ~odd & ~(again & np.isin(word[at], word[at[lower]])) if lower.any() else ~odd
        return at[keep], at[~keep]

    def _alone(self, word: bytes) -> list[int]:
        """One long word, rank by rank."""
        ranks, token = self.ranks, lambda p: word[p : after[p]]
        n = len(word)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        index: dict[int, list[int]] = {}
        for p in range(n - 1):
            if (r := ranks.get(word[p : p + 2])) is not None:
                index.setdefault(r, []).append(p)
        heap = list(index)
        heapify(heap)
        while heap:
            r = heappop(heap)
            places, lower = sorted(set(index.pop(r))), False
            for n_th, p in enumerate(places):
                q = after[p] if alive[p] else n
                if q >= n or ranks.get(word[p : after[q]]) != r:
                    continue
                if lower:  # a pair of a lower rank has come up: it goes first
                    if r not in index:
                        heappush(heap, r)
                    index[r] = index.get(r, []) + places[n_th:]
                    break
                alive[q] = False
                after[p] = s = after[q]
                if s < n:
                    before[s] = p
                for left, end in ((before[p], s), (p, after[s] if s < n else -1)):
                    if left >= 0 and end > 0 and (new := ranks.get(word[left:end])) is not None:
                        if new not in index:
                            heappush(heap, new)
                            index[new] = []
                        index[new].append(left)
                        lower |= new < r
        out, p = [], 0
        while p < n:
            out.append(ranks[token(p)])
            p = after[p]
        return out


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Codec:
    """Whole texts to ids and back. hot: the ids of the corpus's frequent words. The ids of stretches already met are
    remembered up to a bound; words that are not hot are replayed, all new ones of a chunk together."""

    def __init__(self, path: str, pattern: str = PRE_TOKEN, hot: tuple[list[str], np.ndarray, np.ndarray] | None = None):
        self.replay, self.split = _replay(path), Splitter(pattern)
        self.pieces = Pieces(self._learn, REMEMBERED)
        names, self.hot_ids, self.hot_sizes = hot or ([], np.zeros(0, np.uint32), np.zeros(0, np.int64))
        self.hot = {w: i for i, w in enumerate(names)}

    def _learn(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [self.split.words(s) for s in stretches]
        codes = Codes(self.hot)
        flat = codes.of([w for x in words for w in x])
        fresh, sizes = self.replay.replay([w.encode() for w in list(codes)[len(self.hot) :]])
        ids, sizes = np.concatenate([self.hot_ids, fresh]), np.concatenate([self.hot_sizes, sizes])
        starts, n = np.cumsum(sizes) - sizes, sizes[flat]
        ends = np.cumsum(n)
        where = np.repeat(starts[flat] - (ends - n), n)
        per = np.fromiter(map(len, words), np.int64, len(words))
        return ids[where + np.arange(len(where))], np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)])])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's end."""
        names, codes, counts = self.split.distinct(texts)
        ids, lengths = self.pieces.ids_of(names, codes)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]


@lru_cache(maxsize=2)
def _replay(path: str) -> MergeReplay:
    return MergeReplay(load_ranks(path))


def _encode(path: str, pattern: str, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern, hot.value)  # gone with the task: a worker may go on to other work
        for batch, texts in text_chunks(batches, "text", 2 << 20):
            ids, ends = codec.encode(texts)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view(np.int32)))], ["id", "ids"])

    return run


def _round_trip(path: str, pattern: str, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sha = Codec(path, pattern, hot.value), lambda b: hashlib.sha256(b).hexdigest()
        for batch, texts in text_chunks(batches, "text", 2 << 20):
            ids, ends = codec.encode(texts)
            back, places = codec.replay.decode(ids)
            places = np.concatenate([[0], places])
            edges = [0, *ends.tolist()]
            raw, back = memoryview(ids.astype("<u4").tobytes()), memoryview(back)
            byte = places[edges].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(edges), pa.int64()), pa.array([sha(raw[4 * a : 4 * b]) for a, b in zip(edges, edges[1:])]), pa.array([sha(back[a:b]) for a, b in zip(byte, byte[1:])])],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _replay(path).decode
        for batch in batches:
            texts = [decode(np.asarray(x or [], np.int64))[0] for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], ["id", "bytes"])

    return run


def _with_ids(path: str):
    """word -> word, its ids: the replay of the corpus's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in text_chunks(batches, "word"):
            ids, sizes = _replay(path).replay([w.encode() for w in words])
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.array(ids.view(np.int32)))], ["word", "ids"])

    return run


def _hot(base: DataFrame, path: str, pattern: str, most: int):
    """The corpus's most frequent words with their ids, broadcast."""

    def splits():
        split = Splitter(pattern)
        return split.distinct, split.words

    counted = cut(base.select("text").mapInArrow(count_words(splits), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    found = most_frequent(counted, most).select("word").mapInArrow(_with_ids(path), "word string, ids array<int>").toArrow()
    ids = found.column("ids").combine_chunks()
    flat, sizes = ids.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), np.diff(ids.offsets.to_numpy()).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    return base.sparkSession.sparkContext.broadcast((found.column("word").to_pylist(), flat, sizes))


def _input(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base, base.schema["id"].dataType.simpleString()


def bpe_encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = PRE_TOKEN, hot_words: int = HOT_WORDS) -> DataFrame:
    """Ids of each whole text, each match of pattern separately, without special tokens: id_col, ids array<int>.

    1. The distinct words of the whole corpus are counted: in the tasks, then by Spark, and written to the shared folder.
    2. MergeReplay runs once over the hot_words most frequent ones, in Spark tasks; they are broadcast with their ids.
    3. Documents are read off that table. Words beyond it, each rare, are replayed together with all other new ones of the
       chunk (2 MB) in which they are met, so that neither they nor the texts are shuffled.

    A null text counts as empty and gives no ids. Each input row gives one row; ids may be null or repeat; other columns
    are ignored; an empty table gives an empty table. hot_words changes the work only, never the ids.
    """
    base, kind = _input(docs, id_col, text_col)
    return base.mapInArrow(_encode(ranks_path, pattern, _hot(base, ranks_path, pattern, hot_words)), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of each id array: id_col, bytes. A null array gives no bytes; an id that the rank file lacks is an error."""
    base = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(_decode(ranks_path), f"id {kind}, bytes binary").withColumnRenamed("id", id_col)


def bpe_round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = PRE_TOKEN, hot_words: int = HOT_WORDS) -> DataFrame:
    """Encodes as bpe_encode does and decodes in the same task: id_col, n_tokens, ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers), decoded_sha256 (of the decoded bytes). Nulls, repeats and empty tables as in bpe_encode."""
    base, kind = _input(docs, id_col, text_col)
    return base.mapInArrow(_round_trip(ranks_path, pattern, _hot(base, ranks_path, pattern, hot_words)), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
