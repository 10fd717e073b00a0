"""Substring deduplication: word runs that an earlier document has too are found with suffix automata and removed.

The reference is the corpus itself, so its automata cannot be broadcast: they grow with it. They are dealt out instead. A
window's anchor is the least hash of the short word runs within it, so equal windows have equal anchors and meet in one
shard; a shard's reference is the distinct stretches of text around its anchors that occur in more than one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import chunks, cut, text_chunks

#: Words of the runs whose hash can be an anchor.
ANCHOR = 5
#: Bits of the filter of repeated anchors for each of them, and the most in all (64 MB). Beyond that the filter lets more
#: stretches through that occur once; results stay the same.
FILTER_BITS, MOST_BITS = 16, 1 << 29
#: Distinct stretches of one anchor that one automaton takes; a larger anchor's windows are compared by a Spark aggregation.
SHARD = 2000

#: Anchors beyond SHARD that are broadcast (8 bytes each); more are joined by a shuffle.
MOST_LARGE = 100_000

_B = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Text whose word hashes are computed at a time; the tables of powers have as many entries.
BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """_B**i and its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_B), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(BLOCK_BYTES, x, np.uint64))]) for x in (_B, inverse))


def _word_hash(word: bytes) -> int:
    """The sum of (byte + 1) * _B**place modulo 2**64."""
    value, power = 0, 1
    for byte in word:
        value = (value + (byte + 1) * power) & 0xFFFFFFFFFFFFFFFF
        power = power * int(_B) & 0xFFFFFFFFFFFFFFFF
    return value


class Words:
    """The words of the texts of a batch: where they lie in its bytes, the row they are of, and a hash of each."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        self.data = b"".join(texts.to_pylist())
        data = np.frombuffer(self.data, np.uint8)
        solid = ~_SPACE[data]
        before = np.concatenate([[True], ~solid[:-1]]) if len(data) else solid
        after = np.concatenate([~solid[1:], [True]]) if len(data) else solid
        before[begins[begins < len(data)]] = True
        after[ends[ends > 0] - 1] = True
        self.start, self.end = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
        self.row = np.searchsorted(ends, self.start, side="right")
        self.first = np.searchsorted(self.row, np.arange(len(texts)))  # the first word of each row
        with np.errstate(over="ignore"):
            if len(data) <= BLOCK_BYTES:
                up, down = _powers()
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
                value = (sums[self.end] - sums[self.start]) * down[self.start]
            else:  # one long text: distinct words one by one, so that memory stays near the text's size
                known: dict[bytes, int] = {}
                value = np.empty(len(self.start), np.uint64)
                for i, (s, e) in enumerate(zip(self.start.tolist(), self.end.tolist(), strict=True)):
                    word = self.data[s:e]
                    if (h := known.get(word)) is None:
                        h = known[word] = _word_hash(word)
                    value[i] = h
            self.hash = _mix(value)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows that lie in one row: their places, their anchors' hashes and places."""
        least, place = anchors(self.hash, window)
        at = np.flatnonzero(self.row[: len(least)] == self.row[window - 1 :]) if len(least) else np.zeros(0, np.int64)
        return at, least[at], place[at]


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of so many words: the hash of its anchor and the place where the anchor starts (the first of equals)."""
    size = min(ANCHOR, window)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        run = np.zeros(len(hashes) - size + 1, np.uint64)
        for j in range(size):
            run = run * _B + hashes[j : j + len(run)]
        run = _mix(run)
    least, place = run[:n].copy(), np.arange(n)
    for j in range(1, window - size + 1):
        lower = run[j : j + n] < least
        least[lower] = run[j : j + n][lower]
        place[lower] = (np.arange(n) + j)[lower]
    return least, place


def _anchor_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BLOCK_BYTES):
            words = Words(batch.column("text"))
            at, least, _ = words.anchors(window)
            row = words.row[at]
            if len(at):
                new = np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])])
                yield pa.RecordBatch.from_arrays([pa.array(least[new].view(np.int64)), batch.column("id").take(pa.array(row[new]))], ["anchor", "id"])

    return run


def _bits(anchors: np.ndarray, n_bits: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        again = _mix(anchors + _B)
        return [(anchors + np.uint64(k) * (again | np.uint64(1))) % np.uint64(n_bits) for k in range(4)]


def _bit_words(n_bits: int, slices: int):
    """Anchors -> the 64-bit words of the filters that they set bits in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("anchor").to_numpy().view(np.uint64)
            number = (found >> np.uint64(40)) % np.uint64(slices)
            place = np.concatenate(_bits(found, n_bits))
            bit = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(number, 4).astype(np.int64)), pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bit)], ["slice", "word", "bits"])

    return run


def _filter_slice(n_bits: int):
    """The words of one slice -> its filter; there are n_bits / 64 of them at most."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bits = np.zeros(-(-n_bits // 64), np.int64)
        bits[table.column("word").to_numpy()] = table.column("bits").to_numpy()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.astype("<i8").tobytes()], pa.binary())})

    return run


def _passes(filters: list[np.ndarray | None], n_bits: int, found: np.ndarray) -> np.ndarray:
    out, slices = np.zeros(len(found), bool), len(filters)
    number = (found >> np.uint64(40)) % np.uint64(slices)
    for k, bits in enumerate(filters):
        own = np.flatnonzero(number == k) if slices > 1 else np.arange(len(found))
        if bits is None or not len(own):
            continue
        ok = np.ones(len(own), bool)
        for place in _bits(found[own], n_bits):
            place = place.astype(np.int64)
            ok &= (bits[place >> 6] >> (place & 63) & 1).astype(bool)
        out[own[ok]] = True
    return out


def _stretches(window: int, n_bits: int, shared):
    """Maximal runs of windows that have one anchor and pass the filter: where they start, and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [None if b is None else np.frombuffer(b, "<i8") for b in shared.value]
        for batch in chunks(batches, "text", BLOCK_BYTES):
            words = Words(batch.column("text"))
            at, least, place = words.anchors(window)
            if not len(at):
                continue
            new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (words.row[at[1:]] != words.row[at[:-1]])]))
            last = np.append(new[1:], len(at)) - 1
            keep = _passes(filters, n_bits, least[new])
            first, final = at[new[keep]], at[last[keep]] + window - 1
            if not len(first):
                continue
            data = words.data
            texts = [b" ".join(data[s:e].split()) for s, e in zip(words.start[first].tolist(), words.end[final].tolist(), strict=True)]
            name = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
            row = words.row[first]
            where = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(where), batch.column("key").take(where), pa.array(least[new[keep]].view(np.int64)), pa.array(name), pa.array(first - words.first[row]), pa.array(texts, pa.binary()).cast(pa.string())],
                ["id", "key", "anchor", "name", "start", "words"],
            )

    return run


class SuffixAutomaton:
    """Of many word sequences with an owner each; a state knows the least owner of the sequences its words occur in."""

    def __init__(self):
        self.next, self.link, self.length, self.owner = [{}], [-1], [0], [None]

    def add(self, words: list, owner: int) -> None:
        nxt, link, length, own, last = self.next, self.link, self.length, self.owner, 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None:
                if length[q] != length[last] + 1:
                    q = self._split(last, w, q)
                last = q
            else:
                new = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                own.append(None)
                p = last
                while p != -1 and w not in nxt[p]:
                    nxt[p][w] = new
                    p = link[p]
                if p != -1:
                    q = nxt[p][w]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
                last = new
            p = last  # owners of the suffixes that end here
            while p > 0 and (own[p] is None or owner < own[p]):
                own[p] = owner
                p = link[p]

    def _split(self, p: int, w, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.owner.append(self.owner[q])
        self.link[q] = new
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def statistics(self, words: list, least: int) -> list:
        """For each place the least owner of the `least` words that end there, None if they occur nowhere or are too few."""
        nxt, link, length, own = self.next, self.link, self.length, self.owner
        state, size, out = 0, 0, []
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                size += 1
            while state and length[link[state]] >= least:
                state = link[state]
                size = length[state]
            out.append(own[state] if size >= least else None)
        return out


def _shards(window: int):
    """Rows sorted by anchor: distinct stretches and their least owner -> the least owner of each of their windows."""

    def solve(rows: list[tuple]) -> list[list]:
        if len(rows) == 1:
            return [[rows[0][3]] * (rows[0][2].count(" ") + 2 - window)]
        split = [w.split(" ") for _, _, w, _ in rows]
        automaton = SuffixAutomaton()
        for words, (_, _, _, owner) in zip(split, rows, strict=True):
            automaton.add(words, owner)
        return [automaton.statistics(words, window)[window - 1 :] for words in split]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(groups: list[list[tuple]]):
            done = [(a, n, owners) for g in groups for (a, n, _, _), owners in zip(g, solve(g), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([a for a, _, _ in done], pa.int64()), pa.array([n for _, n, _ in done], pa.int64()), pa.array([o for *_, o in done], pa.list_(pa.int64()))], ["anchor", "name", "owners"])

        for batch in batches:
            groups, rows = [], zip(*(batch.column(c).to_pylist() for c in ("anchor", "name", "words", "owner")), strict=True)
            for row in rows:
                if held and held[0][0] != row[0]:
                    groups.append(held)
                    held = []
                held.append(row)
            if groups:
                yield out(groups)
        if held:
            yield out([held])

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "words"):
            split = [t.split(" ") for t in texts]
            counts = [len(w) - window + 1 for w in split]
            at = pa.array(np.repeat(np.arange(len(texts)), counts))
            place = np.concatenate([np.arange(n) for n in counts])
            runs = [" ".join(w[i : i + window]) for w, n in zip(split, counts, strict=True) for i in range(n)]
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(at), batch.column("name").take(at), pa.array(place), pa.array(runs), batch.column("owner").take(at)], ["anchor", "name", "place", "run", "owner"])

    return run


def _removed(window: int, details: bool):
    """Documents with the starts of the windows to remove -> what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, "text"):
            total, gone, kept, spans = [], [], [], []
            for text, starts in zip(texts, batch.column("starts").to_pylist(), strict=True):
                words = text.encode().split()
                marks = np.zeros(len(words) + 1, np.int64)
                if starts:
                    np.add.at(marks, np.array(starts), 1)
                    np.add.at(marks, np.array(starts) + window, -1)
                cover = np.cumsum(marks[:-1]) > 0
                if details:
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]]).astype(np.int8)))
                    spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)])
                total.append(len(words))
                gone.append(int(cover.sum()))
                kept.append(b" ".join([w for w, c in zip(words, cover.tolist(), strict=True) if not c] if starts else words))
            out = {"id": batch.column("id"), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}
            if details:
                out["kept"] = pa.array(kept, pa.binary()).cast(pa.string())
                out["spans"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*out.values()], [*out])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, details: bool = True) -> DataFrame:
    """Each whole text without the words of windows (window words in a row) that a document of a smaller id has too: id_col,
    n_words, n_removed, kept_sha256 (of the other words, joined by one space) and, with details, kept (those words themselves)
    and spans (start, end; of words removed).

    1. The anchors of all windows are counted: those of more than one document are the repeated ones. A filter of their
       hashes, of a bounded size, is broadcast; it may pass others, which costs time only.
    2. Stretches around passing anchors leave the documents; equal ones become one row with its least id before they move.
    3. An anchor's stretches are one shard's reference. A suffix automaton with the least owner of each state gives, by the
       matching statistics of the stretches themselves, the least owner of each window. Anchors of more than SHARD
       stretches (a passage beside many different neighbours) have their windows aggregated by Spark instead.
    4. Windows whose least owner is smaller than their document's id are removed; overlapping ones make maximal spans.

    Words are split at ASCII white space. A null text has no words. A null id is smaller than none: nothing is removed from
    such rows nor because of them. Rows with equal ids do not count against each other, and each gives a row. An empty
    table gives an empty table. Ids must be whole numbers. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = base.filter("id is not null")
    repeated = cut(named.mapInArrow(_anchor_rows(window), "anchor long, id long").groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("anchor"), "anchors")
    total = repeated.count()
    bits = min(MOST_BITS, max(1 << 16, FILTER_BITS * total))
    slices = max(1, bits >> 25)
    n_bits = -(-bits // slices)
    set_bits = repeated.mapInArrow(_bit_words(n_bits, slices), "slice long, word long, bits long").groupBy("slice", "word").agg(F.bit_or("bits").alias("bits"))
    made = {r["slice"]: bytes(r["bits"]) for r in set_bits.groupBy("slice").applyInArrow(_filter_slice(n_bits), "slice long, bits binary").toLocalIterator()}
    shared = spark.sparkContext.broadcast([made.get(k) for k in range(slices)])

    keyed = base.withColumn("key", F.xxhash64("text"))
    found = cut(keyed.filter("id is not null").mapInArrow(_stretches(window, n_bits, shared), "id long, key long, anchor long, name long, start long, words string"), "stretches")
    distinct = cut(found.groupBy("anchor", "name", "words").agg(F.min("id").alias("owner")), "distinct")
    large = cut(distinct.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD).select("anchor"), "large")
    large = F.broadcast(large) if large.count() <= MOST_LARGE else large
    small = distinct.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor").select("anchor", "name", "words", "owner").mapInArrow(_shards(window), "anchor long, name long, owners array<long>")
    runs = cut(distinct.join(large, "anchor", "left_semi").select("anchor", "name", "words", "owner").mapInArrow(_windows(window), "anchor long, name long, place long, run string, owner long"), "windows")
    lowest = runs.groupBy("run").agg(F.min("owner").alias("low"))
    wide = runs.join(lowest, "run").groupBy("anchor", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "low"))), lambda x: x["low"]).alias("owners"))

    # An anchor and the hash of a stretch's words, 128 bits together, stand for the words from here on; what tells rows of one
    # id apart and the place of the stretch share a long, 32 bits each.
    met = found.select("id", F.shiftleft("key", 32).bitwiseOR(F.col("start")).alias("at"), "anchor", "name").join(small.union(wide), ["anchor", "name"])
    starts = met.select("id", F.explode(F.filter(F.transform("owners", lambda o, i: F.when(o < F.col("id"), F.col("at") + i)), lambda x: x.isNotNull())).alias("at"))
    starts = starts.select("id", F.shiftrightunsigned("at", 32).alias("key"), F.col("at").bitwiseAND(0xFFFFFFFF).alias("at"))
    keyed = keyed.withColumn("key", F.col("key").bitwiseAND(0xFFFFFFFF))
    return _apply(keyed, starts, window, details).withColumnRenamed("id", id_col)


def _apply(keyed: DataFrame, starts: DataFrame, window: int, details: bool) -> DataFrame:
    lists = starts.groupBy("id", "key").agg(F.collect_set("at").alias("starts"))
    joined = keyed.join(lists, ["id", "key"], "left").select("id", "text", "starts")
    more = ", kept string, spans array<struct<start:long,end:long>>" if details else ""
    return joined.mapInArrow(_removed(window, details), f"id long, n_words long, n_removed long, kept_sha256 string{more}")
