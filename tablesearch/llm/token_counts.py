"""Token counts: pieces are counted once per distinct pre-token and summed per document without making ids."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Codes, cut, text_chunks
from .words import PRE_TOKEN, Splitter, count_words, most_frequent

#: The hot pre-tokens that may be broadcast with their counts (about 10 MB as a dictionary); all others are joined by a shuffle.
HOT_PIECES = 100_000


@lru_cache(maxsize=2)
def _splitter(path: str):
    """As the tokenizer file defines them: a function from texts to (their distinct stretches, which of them each stretch is,
    the stretches of each text, the special tokens in each), and one from a stretch to its pre-tokens."""
    spec = json.load(open(path, encoding="utf-8"))
    pre = spec["pre_tokenizer"]
    if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
        raise ValueError("pre-token counts need a byte-level vocabulary without a normalizer or prefix space")
    splitter = Splitter(PRE_TOKEN)
    added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    cut_at = regex.compile("|".join(map(regex.escape, added))) if added else None

    def split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        parts = [cut_at.split(t) if cut_at and any(h in t for h in added) else [t] for t in texts]
        per = np.fromiter(map(len, parts), np.int64, len(parts))
        names, codes, counts = splitter.distinct(list(chain.from_iterable(parts)))
        return names, codes, np.add.reduceat(counts, np.cumsum(per) - per) if len(per) else counts, per - 1

    return split, splitter.words


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _vocabulary(path: str):
    return count_words(lambda: _splitter(path))


def _counted(path: str):
    """word, n -> word, n, tokens of the word alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path).encode_batch
        for batch, words in text_chunks(batches, "word", 1 << 18):
            tokens = [len(e.ids) for e in encode(words, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(tokens, pa.int64())], ["word", "n", "tokens"])

    return run


def _documents(path: str, hot):
    """A row (base 1) for each document with the tokens of its hot pre-tokens, and one for each of its other pre-tokens.

    The first kind has a key of its own that is no pre-token (none has a digit beside a sign), so both go through one join.
    """

    names_out = ["id", "key", "n_bytes", "word", "n", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (split, words_in), known = _splitter(path), hot.value
        for batch, texts in text_chunks(batches, "text"):
            stretches, flat, counts, special = split(texts)
            row = np.repeat(np.arange(len(texts)), counts)
            # Of each distinct stretch: the tokens of its hot words, and its other words.
            words = [words_in(s) for s in stretches]
            own = np.repeat(np.arange(len(words)), [len(w) for w in words])
            each = list(chain.from_iterable(words))
            tokens = np.fromiter((known.get(w, 0) for w in each), np.int64, len(each))
            sums = special + np.bincount(row, np.bincount(own, tokens, len(words))[flat], len(texts)).astype(np.int64)
            names, rare = Codes(), np.flatnonzero(tokens == 0)
            code, per = names.of([each[i] for i in rare.tolist()]), np.bincount(own[rare], minlength=len(words))
            begin, times = np.cumsum(per) - per, per[flat]
            place = np.repeat(begin[flat] - (np.cumsum(times) - times), times)
            pair, freq = np.unique(np.repeat(row, times) * max(len(names), 1) + code[place + np.arange(len(place))], return_counts=True)
            at, word = np.divmod(pair, max(len(names), 1))
            marks = pa.array([f"\0{k}" for k in batch.column("key").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), batch.column("n_bytes"), marks, pa.array(sums), pa.array(np.ones(len(texts), np.int64))], names_out)
            if len(pair):
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("key").take(at), batch.column("n_bytes").take(at), pa.array(list(names), pa.string()).take(pa.array(word)), pa.array(freq.astype(np.int64)), pa.array(np.zeros(len(pair), np.int64))], names_out)

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """Tokens of each whole text: id_col, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    tokenizer_path: a byte-level BPE file of the tokenizers library, at the same place on every machine. Special strings
    inside a text are single tokens, the library's default.

    1. Distinct pre-tokens with their frequency: combined in the tasks, then by Spark, written to the shared folder
       together with the number of pieces of each.
    2. The at most hot_pieces most frequent ones are broadcast; a task adds their pieces up per document. All others
       leave the task as (document, pre-token, frequency) and are joined to the table of 1; Spark sums both per document.

    A null text counts as empty: 0 bytes, 0 tokens. Each input row gives one row, also rows with equal or null ids. An
    empty table gives an empty table. Other columns are ignored. Texts may be of any length.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    vocabulary = base.select("text").mapInArrow(_vocabulary(tokenizer_path), "word string, n long")
    vocabulary = cut(vocabulary.groupBy("word").agg(F.sum("n").alias("n")).mapInArrow(_counted(tokenizer_path), "word string, n long, tokens long"), "pieces")
    # A word of no token at all would look unknown; byte-level vocabularies have none.
    hot = {r[0]: r[1] for r in most_frequent(vocabulary, hot_pieces).filter("tokens > 0").select("word", "tokens").collect()}

    keyed = base.select("id", F.xxhash64("text").alias("key"), F.octet_length("text").cast("long").alias("n_bytes"), "text")
    parts = keyed.mapInArrow(_documents(tokenizer_path, spark.sparkContext.broadcast(hot)), f"id {base.schema['id'].dataType.simpleString()}, key long, n_bytes long, word string, n long, base long")
    joined = parts.join(vocabulary.select("word", "tokens"), "word", "left").withColumn("n", F.col("n") * F.when(F.col("base") == 1, F.lit(1)).otherwise(F.col("tokens")))
    sums = joined.groupBy("id", "key", "n_bytes").agg(F.sum("n").alias("n"), F.sum("base").alias("rows"))
    each = sums.select("id", "n_bytes", (F.col("n") / F.col("rows")).cast("long").alias("n_tokens"), F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    return each.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
