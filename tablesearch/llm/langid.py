"""Language identification: known words by their frequency in each language, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Codes, cut, fold, text_chunks

#: Bounds of the fit, parameters of fit(): distinct labelled texts it learns from (by hash, each language in proportion but
#: FLOOR at least, or all it has); words and n-grams that the model keeps of each language, the most frequent ones.
SAMPLE_DOCS, FLOOR, WORDS, GRAMS = 20_000, 500, 30_000, 10_000
LONGEST = 4
UNKNOWN = "und"
#: Words of evidence up to which a document's score sharpens.
EVIDENCE = 20
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


@dataclass
class Model:
    languages: list[str]
    words: dict[str, np.ndarray]  # log frequency in each language
    grams: list[dict[str, np.ndarray]]  # by length - 1
    unseen: np.ndarray

    def word(self, word: str) -> np.ndarray:
        found = self.words.get(word)
        return self.backoff(word) if found is None else found

    def backoff(self, word: str) -> np.ndarray:
        """The mean over the word's places of the longest known n-gram that starts there; places without one count nothing."""
        marked, total, n = f"_{word}_", np.zeros(len(self.languages)), 0
        for i in range(len(marked)):
            for size in range(min(LONGEST, len(marked) - i), 0, -1):
                found = self.grams[size - 1].get(marked[i : i + size])
                if found is not None:
                    total += found
                    n += 1
                    break
        return total / n if n else self.unseen


class Scorer:
    """Sums of word scores of many texts; the words met are remembered up to a bound."""

    def __init__(self, model: Model, max_words: int = 250_000):
        self.model, self.max_words = model, max_words
        self.clear()

    def clear(self):
        self.codes, self.table, self.known = Codes(), np.zeros((1 << 12, len(self.model.languages)), np.float32), 0

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.model.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        if len(self.codes) > self.max_words:
            self.clear()
        out = []
        words = [words_of(t) for t in texts]
        codes = [self.codes.of(w) for w in words]
        if (n := len(self.codes)) > self.known:
            if n > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(len(self.table), n - len(self.table)), self.table.shape[1]), np.float32)])
            for word in [k for k, _ in zip(reversed(self.codes), range(n - self.known))][::-1]:
                self.table[self.known] = self.model.word(word)
                self.known += 1
        for c in codes:
            if not len(c):
                out.append((UNKNOWN, 0.0))
                continue
            counts = np.bincount(c) if len(c) > 4 * len(self.codes) else None
            total = counts @ self.table[: len(counts)] if counts is not None else self.table[c].sum(axis=0, dtype=np.float64)
            odds = total / len(c) * min(len(c), EVIDENCE)
            odds = np.exp(odds - odds.max())
            best = int(odds.argmax())
            out.append((self.model.languages[best], float(odds[best] / odds.sum())))
        return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush():
        keys = list(seen)
        out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])
        seen.clear()
        return out

    for batch, texts in text_chunks(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            for word, n in Counter(words_of(text)).items():
                seen[lang, word] += n
        if len(seen) > 150_000:
            yield flush()
    if seen:
        yield flush()


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush():
        keys = list(seen)
        out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(seen.values()), pa.int64())], ["lang", "gram", "n"])
        seen.clear()
        return out

    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
            marked = f"_{word}_"
            for size in range(1, LONGEST + 1):
                for i in range(len(marked) - size + 1):
                    seen[lang, marked[i : i + size]] += n
        if len(seen) > 150_000:
            yield flush()
    if seen:
        yield flush()


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of (lang, key, n) with the highest n in their language: whole ties at a time, at most `most` a language, but
    always those of the highest n. A language's frequencies come to the driver as a row for each different one."""
    least, left = {}, {}
    for r in counts.groupBy("lang", "n").agg(F.count("*").alias("keys")).orderBy("lang", F.desc("n")).collect():
        room = left.get(r["lang"], most)
        if r["lang"] not in least or 0 < room >= r["keys"]:
            least[r["lang"]] = r["n"]
            left[r["lang"]] = room - r["keys"]
        else:
            left[r["lang"]] = 0
    if not least:
        return counts.limit(0)
    bounds = F.create_map(*[F.lit(x) for item in least.items() for x in item])
    return counts.filter(F.col("n") >= bounds[F.col("lang")])


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, most_words: int = WORDS, most_grams: int = GRAMS) -> Model:
    """Learn from labelled rows; null texts and null languages teach nothing.

    Whole texts of about sample_docs rows are read; copies of a text in a language are one row, so they neither decide whether
    a language is learnt nor outweigh its other texts. Every language is learnt. Words and n-grams are counted by Spark over all
    of those texts; the model, which the driver holds, has at most most_words words (of two occurrences or more) and most_grams
    n-grams of each language, and ties of the highest frequency. A word that it leaves out is scored by its n-grams, as an
    unseen one is. No rows: a model that knows no language.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("text is not null and lang is not null").withColumn("hash", F.xxhash64("text"))
    texts = rows.groupBy("lang", "hash").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["texts"] for r in texts.groupBy("lang").agg(F.count("*").alias("texts")).collect()}
    if not sizes:
        return Model([], {}, [{} for _ in range(LONGEST)], np.zeros(0))
    share = sample_docs / sum(sizes.values())
    rates = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(int((1 << 32) * min(1.0, max(share, FLOOR / n)))))])
    picked = rows.filter(F.pmod("hash", F.lit(1 << 32)) < rates[F.col("lang")]).groupBy("lang", "hash").agg(F.first("text").alias("text"))
    words = cut(picked.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    known = _frequent(words.filter("n > 1"), most_words).collect()
    grams = cut(words.mapInArrow(_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    pieces = _frequent(grams, most_grams).collect()
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    place = {lang: i for i, lang in enumerate(languages)}
    total = np.array([totals[lang] for lang in languages], float)

    def logs(found, key: str, sums: np.ndarray) -> dict[str, np.ndarray]:
        table: dict[str, np.ndarray] = {}
        for r in found:
            table.setdefault(r[key], np.zeros(len(languages)))[place[r["lang"]]] = r["n"]
        return {k: np.log((v + 0.5) / (sums + 1)).astype(np.float32) for k, v in table.items()}

    by_size = []
    for size in range(1, LONGEST + 1):
        own = [r for r in pieces if len(r["gram"]) == size]
        sums = np.zeros(len(languages))
        for r in own:
            sums[place[r["lang"]]] += r["n"]
        by_size.append(logs(own, "gram", sums))
    return Model(languages, logs(known, "word", total), by_size, np.full(len(languages), math.log(0.5)) - np.log(total + 1))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch, texts in text_chunks(batches, "text"):
            found = scorer.predict(texts)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of each whole text: id_col, lang_pred, score (0 to 1).

    A null text and one without a letter are UNKNOWN with score 0, as is every text if the model knows no language. Ties go
    to the first language by name. Each input row gives one row; an empty table gives an empty table.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = base.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), f"id {base.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def _known(shared, text_col: str, lang_col: str, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch, texts in text_chunks(batches, text_col):
            found = scorer.predict(texts)
            i = batch.schema.get_field_index(lang_col)
            langs = pa.array([own if own is not None else new for own, (new, _) in zip(batch.column(i).to_pylist(), found, strict=True)], batch.schema.field(i).type)
            yield batch.set_column(i, batch.schema.field(i), langs).filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found]))

    return run


def keep_known(docs: DataFrame, model: Model, min_score: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs whose predicted language is not UNKNOWN and scores min_score or more, with all their columns; a null
    language is filled with the predicted one."""
    return docs.mapInArrow(_known(docs.sparkSession.sparkContext.broadcast(model), text_col, lang_col, min_score), docs.schema)


def predict_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out (crc32 of the id modulo 3 is 1), lang_pred, score; learnt from the rows that are not held out."""
    held = fold("doc_id", 3) == 1
    model = fit(docs.filter(~held))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
