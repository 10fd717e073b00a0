"""Words (pre-tokens) of texts, split once for each distinct stretch of text, and their frequencies over the corpus."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Codes, text_chunks

#: The split that byte-level BPE vocabularies of this family apply before the merges.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct stretches that a task counts before it hands them on.
COMBINE = 300_000

_GAP, _WIDE = re.compile(r" (?=\S)"), re.compile(r" (?:\s|$)")


class Splitter:
    """Cuts texts into stretches that can be split into words by themselves, so that a worker splits each stretch once.

    With PRE_TOKEN a space before a sign always begins a word, so the stretches between such spaces are independent. The first
    stretch of a text is marked by a space before it. With another pattern a text's words are its stretches.
    """

    def __init__(self, pattern: str):
        self.find, self.known = regex.compile(pattern).findall, pattern == PRE_TOKEN

    def distinct(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct stretches of the texts; for each stretch in order, which of them it is; the stretches of each text."""
        if self.known and not any(map(_WIDE.search, texts)):  # as _GAP.split, sooner
            lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
            flat, counts = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            lists = [_GAP.split(t) if self.known else self.find(t) for t in texts]
            flat, counts = pa.array(chain.from_iterable(lists), pa.string()), np.fromiter(map(len, lists), np.int64, len(lists))
        found = flat.dictionary_encode()
        names, codes = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy().astype(np.int64)
        if self.known:
            begins, firsts = np.cumsum(counts) - counts, Codes()
            codes[begins] = len(names) + firsts.of([" " + names[c] for c in codes[begins].tolist()])
            names += firsts
        return names, codes, counts

    def words(self, stretch: str) -> list[str]:
        if not self.known:
            return [stretch]
        if stretch.isalpha():  # what findall gives, sooner
            return [" " + stretch]
        if stretch[:-1].isalpha() and stretch[-1] in ".,;:!?":
            return [" " + stretch[:-1], stretch[-1]]
        return self.find(stretch[1:] if stretch[:1] == " " else " " + stretch)


def count_words(splits):
    """A task's function from texts (column text) to their distinct words and how often each occurs (word, n), some repeatedly.

    splits: gives a function from texts to their distinct stretches and the numbers of all, and one from a stretch to its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct, words = splits()
        seen: Counter = Counter()

        def flush():
            found: Counter = Counter()
            for stretch, n in seen.items():
                for word in words(stretch):
                    found[word] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for _, texts in text_chunks(batches, "text"):
            names, codes, *_ = distinct(texts)
            for stretch, n in zip(names, np.bincount(codes, minlength=len(names)).tolist(), strict=True):
                if n:
                    seen[stretch] += n
            if len(seen) > COMBINE:
                yield flush()
        if seen:
            yield flush()

    return run


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The rows of (word, n, ...) with the highest n, whole ties at a time and at most `most` of them. words is read twice."""
    by_n = words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(most).collect()
    least, left = None, most
    for row in by_n:
        left -= row["words"]
        if left < 0:
            break
        least = row["n"]
    return words.filter(F.col("n") >= least) if least is not None else words.limit(0)
