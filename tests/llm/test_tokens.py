"""Token counts, BPE round trips and token files against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tablesearch.llm import bpe, queries, token_counts, token_files

EDGES = [
    (1, "a plain text", "x"),
    (2, "", "x"),
    (3, None, None),
    (4, "   \n\n tabs\tand\x1cseparators\x85  and no-break\xa0space  ", "x"),
    (1005, "special <|endoftext|> inside<|endoftext|>", "x"),
    (6, "漢字 ١٢٣ \U0001f600\U0001f600 İstanbul ΣΑΣ é it's IT'S we'll", "x"),
    (7, "a" * 30000, "x"),
    (8, "word " * 20000, "x"),
    (1, "a plain text", "x"),
    (None, "no id", "x"),
    (None, "no id", "x"),
    (-5, "same id, other text", "x"),
    (-5, "same id", "x"),
]


def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string, n_tokens string")  # a column that clashes with a result


def texts_of(rows):
    return [(i, t or "") for i, t, *_ in rows]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: (r[0] is not None, r))


def by_library(items):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    n = [len(t.encode(x, add_special_tokens=False).ids) for _, x in items]
    return sorted(((i, len(x.encode()), k, k > 1024) for (i, x), k in zip(items, n)), key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize("hot", [100_000, 50, 0])
def test_counts_are_the_library_s(spark, documents, hot):
    df = spark.createDataFrame(documents, "doc_id long, text string").union(edges(spark).select("doc_id", "text"))
    got = token_counts.count_tokens(df, P.path("byte_bpe_50k.json"), hot_pieces=hot)
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == by_library(documents + texts_of(EDGES))


def test_bpe_is_the_library_s(spark, documents):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    df = spark.createDataFrame(documents, "doc_id long, text string").union(edges(spark).select("doc_id", "text"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in texts_of(documents) + texts_of(EDGES):
        ids = enc.encode_ordinary(t)
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.encode())))
    got = bpe.bpe_round_trip(df, P.path("byte_bpe_50k.tiktoken"), pattern=P.PATTERN)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=lambda r: (r[0] is not None, r))
    back = bpe.bpe_decode(bpe.bpe_encode(df, P.path("byte_bpe_50k.tiktoken")), P.path("byte_bpe_50k.tiktoken"))
    assert sorted(bytes(r[0]) for r in back.select("bytes").collect()) == sorted(t.encode() for _, t in documents + texts_of(EDGES))


def test_replay_of_ranks_that_do_not_grow():
    """A made-up vocabulary in which a merge can make a pair of a lower rank than its own."""
    import tiktoken

    rng = random.Random(3)
    for _ in range(30):
        parts = {bytes([b]) for b in range(256)}
        made = set()
        while len(made) < 40:
            a, b = (rng.choice([*made, *(bytes([c]) for c in b"abc")]) for _ in "ab")
            if len(a + b) < 9:
                made.add(a + b)
        tokens = [*sorted(parts), *rng.sample(sorted(made), len(made))]
        ranks = {t: i for i, t in enumerate(tokens)}
        enc = tiktoken.Encoding("x", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 25))) for _ in range(60)]
        assert bpe.MergeReplay(ranks).encode([w.encode() for w in words]) == [enc.encode_ordinary(w) for w in words]


def test_token_files(spark, documents, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    items = [(d, x) for d, x in documents] + [(i, x) for i, x in texts_of(EDGES)]
    df = spark.createDataFrame(documents, "doc_id long, text string").union(edges(spark).select("doc_id", "text")).repartition(7)
    token_files.write_token_files(df, P.path("word_bpe_49k.json"), str(tmp_path / "f"), end_id=1, sample_docs=150, shard_bytes=20_000)
    got = token_files.read_token_files(spark, str(tmp_path / "f"), "ids_crc32").orderBy("start").collect()
    want = df.withColumn("text", F.coalesce("text", F.lit(""))).orderBy("doc_id", F.xxhash64("text"), "text").collect()
    assert len(want) == len(items)
    start = 0
    for (doc, text), row in zip(want, got, strict=True):
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    one = token_files.read_token_files(spark, str(tmp_path / "f")).filter(F.col("doc_id") == 1005).first()
    assert one["ids"] == [*t.encode(EDGES[4][1], add_special_tokens=False).ids, 1]
    assert spark.read.parquet(str(tmp_path / "f" / "shards")).count() > 3


@pytest.mark.parametrize("kind", ["short", "int", "string"])
def test_token_files_of_another_tokenizer(spark, tmp_path, kind):
    """Nothing is split for a tokenizer that keeps white space; ids of any kind."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["Hello world  two", " leading", "", None, "tabs\tand\n\nlines  ", "漢字 it's <|endoftext|> x"] * 3
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    token_files.write_token_files(df, P.path("byte_bpe_50k.json"), str(tmp_path / "f"))
    got = {int(r["doc_id"]): r["ids"] for r in token_files.read_token_files(spark, str(tmp_path / "f")).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}


def test_bpe_of_long_words_and_hot_words(spark):
    """Long words go rank by rank; how many words are hot changes nothing; another pattern is split as it says."""
    import tiktoken

    rng, path = random.Random(2), P.path("byte_bpe_50k.tiktoken")
    texts = ["".join(rng.choice("abcdeé") for _ in range(n)) for n in (255, 256, 257, 5000)] + ["a" * 3001, "x  \n y \u3000z", " a", "a ", "\n a\n  b"] + ["some words some words, more"] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for pattern in (P.PATTERN, r"[\s\S]{1,7}"):
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
        for hot in (0, 3, 1000):
            got = dict(bpe.bpe_encode(df, path, pattern=pattern, hot_words=hot).collect())
            assert got == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}


def test_word_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    path, rng = P.path("word_bpe_49k.json"), random.Random(5)
    t = Tokenizer.from_file(path)
    letters = [*"aAeézÉßİıſœŒüÜ'.,!$<|>_-\"`~^´¨ºªµ0٣١漢 \n\t\x1c\x85\xa0ΣςЯKÅ", "<|endoftext|>", "<|ENDOFTEXT|>", "n\u0303", "'s", "'LL", "J\u030c", "H\u0331", "j\u030c"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    assert token_files._words(path)[0].encode.direct
    assert [x.tolist() for x in token_files.encode_texts(path, texts, None)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("name", ["op3_token_counts", "op7_byte_bpe", "op10_token_files"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
