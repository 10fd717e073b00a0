"""Token-id output: shards of separately compressed documents that share one zstandard dictionary, with an offset index."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Codes, Pieces, checkpoint_dir, text_chunks
from .token_counts import _tokenizer

#: Documents of which the dictionary is trained, the most bytes of ids that it sees of one, and its size. The only bounded
#: sample; every document is written.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 32 << 10, 64 << 10
#: Compressed bytes of a shard's payload, after which the next one begins. A longer document is a shard of its own.
SHARD_BYTES = 4 << 20


#: A word of letters with signs after it: two pre-tokens at most, unless an apostrophe or a special token is in it.
_PLAIN = re.compile(rb"([A-Za-z\x80-\xff]+)([!-&(-/:;=>?@[-`{-~]*)").fullmatch


class WordEncoder:
    """Ids of space-free words, as the tokenizer gives them for the whole text: it drops white space and joins nothing across.

    Words of Latin letters, which the normalizer only lower-cases, go to the tokenizer's model directly; a run of signs after
    them is a pre-token of its own. All other words go through the whole tokenizer. A tokenizer that is not known to work in
    this way gets whole texts.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = str((spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern"))
        self.direct = kinds == ["NFC", "Replace", "Lowercase"] and r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in split
        self.tokenizer = _tokenizer(path)
        # Byte-level vocabularies write printable Latin-1 bytes as themselves and the others as code points from 256 on.
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: b if b in kept else 256 + n for n, b in enumerate(x for x in [*[x for x in range(256) if x not in kept], *kept])}

    def distinct(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct words of the texts; for each word in order, which of them it is; the words of each text. They are in lower
        case where that changes no id, so that fewer words differ. It could change one beside a combining mark (UTF-8 bytes from
        CC or CD on), which composes with some letters in one case only, and in what looks like a special token. For a tokenizer
        that is not known each text is one word."""
        raw = [t.encode() for t in texts]
        if self.direct:
            lists = pc.ascii_split_whitespace(pa.array([t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower() for t in raw], pa.binary()).cast(pa.string()))
            found, counts = lists.flatten().cast(pa.binary()).dictionary_encode(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            found, counts = pa.array(raw, pa.binary()).dictionary_encode(), np.ones(len(texts), np.int64)
        return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy().astype(np.int64), counts

    def one_by_one(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)] if words else []

    def stem(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))]

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and their number for each word."""
        if not self.direct:
            return _flat(self.one_by_one([w.decode() for w in words]))
        stems, others = Codes(), Codes({"": 0})
        place = np.zeros((len(words), 2), np.int64)  # of each word's two parts: n is the n-th stem, -1 - n the n-th other piece
        for i, word in enumerate(words):
            if m := _PLAIN(word):
                stem = m[1].decode().lower()
                if stem.isascii() or stem.isalpha() and max(stem) < "\u0250":
                    place[i] = stems[stem], -1 - others[m[2].decode()]
                    continue
            place[i] = -1, -1 - others[word.decode()]  # no stem: the empty piece
        ids, sizes = _flat([*map(self.stem, stems), *self.one_by_one(list(others))])
        place = np.where(place < 0, len(stems) - 1 - place, place).ravel()
        starts, lengths = np.cumsum(sizes) - sizes, sizes[place]
        where = np.repeat(starts[place] - (np.cumsum(lengths) - lengths), lengths)
        return ids[where + np.arange(len(where))], lengths.reshape(-1, 2).sum(axis=1)


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


@lru_cache(maxsize=1)
def _words(path: str) -> tuple[Pieces, bool]:
    return Pieces(WordEncoder(path), 700_000), _tokenizer(path).get_vocab_size() <= 1 << 16


def encode_texts(path: str, texts: list[str], end_id: int | None) -> list[np.ndarray]:
    """Ids of each text, with end_id after them if one is given."""
    pieces, _ = _words(path)
    names, codes, counts = pieces.encode.distinct(texts)
    ids, lengths = pieces.ids_of(names, codes)
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
    out = np.split(ids, ends[:-1]) if len(ends) else []
    return out if end_id is None else [np.append(x, np.uint32(end_id)) for x in out]


def _serialized(ids: np.ndarray, short: bool) -> bytes:
    return ids.astype("<u2" if short else "<u4").tobytes()


def _samples(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches, "text"):
            short = _words(path)[1]
            yield pa.RecordBatch.from_arrays([pa.array([_serialized(x, short)[:SAMPLE_BYTES] for x in encode_texts(path, texts, end_id)], pa.binary())], ["ids"])

    return run


def _shards(path: str, end_id: int | None, dictionary, shard_bytes: int):
    """Documents of a sorted partition -> shards: a payload of frames and, for each document, where its frame lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        words, short = _words(path)
        trained = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True).compress
        digest = hashlib.sha256(dictionary.value).hexdigest()
        docs, frames, counts, kind = [], [], [], None

        def shard():
            sizes = np.array([len(f) for f in frames], np.int64)
            one = lambda x, t: pa.array([x], pa.list_(t))
            ids = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.array(docs, kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([digest]), pa.array([2 if short else 4], pa.int32()), ids, one(np.cumsum(sizes) - sizes, pa.int64()), one(sizes, pa.int64()), one(counts, pa.int64()), pa.array([b"".join(frames)], pa.binary())],
                ["part", "shard", "dictionary", "id_bytes", "docs", "offsets", "lengths", "n_tokens", "payload"],
            )

        held = 0
        for batch, texts in text_chunks(batches, "text"):
            kind = batch.schema.field("id").type
            for doc, ids in zip(batch.column("id").to_pylist(), encode_texts(path, texts, end_id), strict=True):
                frame = squeeze(_serialized(ids, short))
                if frames and held + len(frame) > shard_bytes:
                    yield shard()
                    number, held = number + 1, 0
                    docs, frames, counts = [], [], []
                docs.append(doc)
                frames.append(frame)
                counts.append(len(ids))
                held += len(frame)
        if frames:
            yield shard()

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = None, sample_docs: int = SAMPLE_DOCS, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode each whole text (end_id after it) and write the ids under folder, in ascending order of id_col.

    folder/dictionary  one row: the zstandard dictionary and its SHA-256. It is trained on the first ids (32 KB) of about
                       sample_docs documents; with too few to train on it is empty and frames stand alone.
    folder/shards      rows of at most shard_bytes of frames: part and shard (their order), the dictionary's hash, bytes per
                       id, the payload (frames end to end) and, as the offset index, document ids, offsets, lengths and
                       token counts in the order of the payload. A short document is had by one slice and one frame.

    folder is any place Spark can write. A null text gives end_id alone (no ids without one). Null document ids come first;
    documents with equal ids are neighbours, by a hash of the text. An empty table gives no shards. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = base.count()
    picked = base.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 32)) < F.lit(int((1 << 32) * min(1.0, sample_docs / max(total, 1)))))
    samples = [bytes(r[0]) for r in picked.select("text").mapInArrow(_samples(tokenizer_path, end_id), "ids binary").collect()]
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:  # too little to train on
        dictionary = b""
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "hash string, dictionary binary").write.parquet(f"{folder}/dictionary")
    kind = base.schema["id"].dataType.simpleString()
    base = base.withColumn("hash", F.xxhash64("text"))  # ranges are fitted to a sample of ids and hashes, never of texts
    ordered = base.repartitionByRange("id", "hash") if total else base
    shards = ordered.sortWithinPartitions("id", "hash", "text").select("id", "text").mapInArrow(
        _shards(tokenizer_path, end_id, spark.sparkContext.broadcast(dictionary), shard_bytes),
        f"part long, shard long, dictionary string, id_bytes int, docs array<{kind}>, offsets array<long>, lengths array<long>, n_tokens array<long>, payload binary",
    )
    shards.write.parquet(f"{folder}/shards")


def _open(payload: str, dictionaries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        openers = {h: zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None) for h, d in dictionaries.value.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                data, width, opener = memoryview(row["payload"].as_buffer()), row["id_bytes"].as_py(), openers[row["dictionary"].as_py()]
                ids = [np.frombuffer(opener.decompress(data[o : o + n]), f"<u{width}").astype("<u4") for o, n in zip(row["offsets"].as_py(), row["lengths"].as_py(), strict=True)]
                docs, n = row["docs"].values, len(ids)
                where = [pa.array([row[x].as_py()] * n, pa.int64()) for x in ("part", "shard")]
                if payload == "ids":
                    last = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids).view(np.int32)))
                else:
                    last = pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([*where, pa.array(range(n), pa.int64()), docs, pa.array([len(x) for x in ids], pa.int64()), last], ["part", "shard", "slot", "id", "n_tokens", payload])

    return run


def read_token_files(spark: SparkSession, folder: str, payload: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """The documents of write_token_files, read from its files: id_col, start (ids of all documents before it), n_tokens,
    and ids (array<int>) or, with payload="ids_crc32", the crc32 of the ids as little-endian unsigned 32-bit integers.

    start adds three sums: of the parts before (one row a part goes to one task), of the part's shards before, and of the
    shard's documents before. The files carry checksums, so a damaged frame is an error.
    """
    dictionaries = {r["hash"]: bytes(r["dictionary"]) for r in spark.read.parquet(f"{folder}/dictionary").collect()}
    shards = spark.read.parquet(f"{folder}/shards")
    kind = shards.schema["docs"].dataType.elementType.simpleString()
    sizes = shards.select("part", "shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    starts = sizes.join(before, "part").select("part", "shard", (F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("shard")) - F.col("n")).alias("first"))
    # A task holds whole shards and yields their documents in order, so the running sum needs no further sort.
    column = "ids array<int>" if payload == "ids" else "ids_crc32 long"
    docs = shards.mapInArrow(_open(payload, spark.sparkContext.broadcast(dictionaries)), f"part long, shard long, slot long, id {kind}, n_tokens long, {column}")
    within = F.sum("n_tokens").over(Window.partitionBy("part", "shard").orderBy("slot")) - F.col("n_tokens")
    return docs.join(starts, ["part", "shard"]).select(F.col("id").alias(id_col), (F.col("first") + within).alias("start"), "n_tokens", payload)


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
