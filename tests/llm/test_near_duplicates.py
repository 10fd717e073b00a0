"""Embedding, SimHash and substring deduplication against plain versions, and connected components."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablesearch.llm import components, embeddings, queries, simhash, substrings


def reach(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    real = [x for x in links if x[0] != x[1]]
    want = reach({x for link in real for x in link}, real)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def cosine_rows(rows):
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    n = {}
    links = []
    for (a, (i, x)), (b, (j, y)) in itertools.combinations(enumerate(good), 2):
        if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95:
            links.append((a, b))
            n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    root = reach(range(len(good)), links)
    low = {}
    for k, (i, _) in enumerate(good):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    out = [(i, n.get(k, 0), low.get(root[k])) for k, (i, _) in enumerate(good)]
    done = {id(v) for _, v in good}
    out += [(i, 0, i) for i, v in rows if not (v and None not in v and all(map(math.isfinite, v)) and any(v))]
    return sorted(((i, k, c, i == c) for i, k, c in out), key=str), done


@pytest.mark.parametrize("side", [8192, 40])
def test_embeddings(spark, side):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (base + rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.3])).astype(np.float32).tolist()))
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e-30, 2e-30]), (3, rows[3][1]), (None, rows[5][1]), (None, [5.0, -5.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, n_links string").repartition(5)
    got = embeddings.near_duplicates(df, side=side)
    assert sorted((tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in got.collect()), key=str) == cosine_rows(rows)[0]
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_extreme_size(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-170, 1e-170]), (4, [1e-170, -1e-170]), (5, [5e-324, 5e-324]), (6, [1.0, -1.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 5: (3, 1), 4: (1, 4), 6: (1, 4)}


def test_quantisation_bound_holds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 64))
    s = embeddings._side(x)
    exact = s[1] @ s[1].T
    rough = (s[2] @ s[2].T) * s[3][:, None] * s[3][None, :]
    bound = s[5][:, None] * (s[4] + s[5])[None, :] + s[4][:, None] * s[5][None, :]
    assert (np.abs(exact - rough) <= bound + 1e-6).all() and bound.max() < 0.05


def fingerprint(text):
    words = text.encode().lower().split() if text else []
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = random.Random(1)
        for _ in range(4000):
            difference = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(m & difference == 0 for m in masks)


def variants():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(400)]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts


@pytest.fixture(scope="module")
def near_texts(spark, sf):
    own = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    return [*enumerate(own + variants() + [None, "", " \n", "One", "one two", "ONE two", "É é  x", "word " * 30000])] + [(3, own[3]), (3, "another text of the same id"), (None, own[4]), (None, "alone without an id")]


@pytest.mark.parametrize("block", [2048, 3])
def test_simhash(spark, near_texts, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    df = spark.createDataFrame([(i, t, 1) for i, t in near_texts], "doc_id long, text string, fingerprint int").repartition(4)
    prints = {k: fingerprint(t) for k, (_, t) in enumerate(near_texts)}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = reach(prints, links)
    low = {}
    for k, (i, _) in enumerate(near_texts):
        if i is not None:
            low[root[k]] = min(low.get(root[k], i), i)
    want = sorted(((i, f"{prints[k]:016x}", low.get(root[k])) for k, (i, _) in enumerate(near_texts)), key=str)
    got = simhash.near_duplicates(df)
    assert sorted((tuple(r[c] for c in ("doc_id", "fingerprint", "component_id")) for r in got.collect()), key=str) == want
    assert len({w[1] for w in want}) > len({w[2] for w in want})  # different fingerprints do link


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def similar_groups(texts):
    """Groups of places by a Jaccard similarity of 0.8 of five-word shingles, every pair compared."""
    sets = [shingles(t) for t in texts]
    return reach(range(len(texts)), [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9])


@pytest.mark.parametrize("block", [2048, 3])
def test_one_of_each_similar_group(spark, sf, block, monkeypatch):
    """The least row of each group stays; at least nine tenths of the others go; columns of any name and type are kept."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng, rows = random.Random(6), [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for g in range(40):
        base = [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(rng.choice([30, 200, 400]))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(max(2, len(base) // 40))):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(1000)}"
            rows.append((1000 + len(rows), " ".join(copy)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "ONE two"), (9005, "one three"), (9006, "word " * 30000), (3, rows[3][1]), (3, "another text of the same id"), (None, rows[4][1]), (None, "alone without an id")]
    df = spark.createDataFrame([(i, t, "mine", 7, {"k": k}, 1) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _key string, _n int, row map<string,int>, id int").repartition(4)
    got = simhash.keep_one_each(df)
    assert got.columns == df.columns
    kept = got.collect()
    assert all(r["_key"] == "mine" and r["_n"] == 7 and rows[r["row"]["k"]] == (r["doc_id"], r["text"]) for r in kept)
    groups = {}
    for k, root in similar_groups([t for _, t in rows]).items():
        groups.setdefault(root, []).append(k)
    left = {r["row"]["k"] for r in kept}
    order = lambda k: (rows[k][0] is None, rows[k][0] or 0)
    for g in groups.values():
        assert any(order(k) == min(map(order, g)) for k in left & set(g))
    assert len(left) - len(groups) <= 0.1 * (len(rows) - len(groups))
    assert simhash.keep_one_each(df.limit(0)).count() == 0


def test_many_fingerprints_of_one_key(spark):
    """Thousands of different fingerprints within three bits: blocks of a key meet each other and all is one group."""
    rng = random.Random(9)
    prints = {sum(1 << b for b in rng.sample(range(64), 1)) ^ sum(1 << b for b in rng.sample(range(64), 1)) for _ in range(3000)}
    values = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_fingerprints(spark.createDataFrame([(v,) for v in values], "fp long"))
    found = components.components(links)
    assert found.count() == len(values) and found.select("component").distinct().count() == 1
    assert links.count() < 100 * len(values)


def removed(rows, window=13):
    low = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            if i is not None:
                w = tuple(words[k : k + window])
                low[w] = min(low.get(w, i), i)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            first = low.get(tuple(words[k : k + window]))
            if i is not None and first is not None and first < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_words_and_hashes(monkeypatch):
    import pyarrow as pa

    texts = ["ab c\tab", None, "", " ", "ab", "ab\x1fc é\x0b\x0c\r\n ab ", "c"]
    want = [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]
    hashes = []
    for limit in (1 << 20, 3):  # at once, and word by word as for one long text
        monkeypatch.setattr(substrings, "BLOCK_BYTES", limit)
        words = substrings.Words(pa.array(texts))
        assert [(r, words.data[s:e]) for r, s, e in zip(words.row.tolist(), words.start.tolist(), words.end.tolist())] == want
        hashes.append(words.hash.tolist())
        monkeypatch.undo()
    assert hashes[0] == hashes[1] and len(set(hashes[0])) == len({w for _, w in want})


@pytest.mark.parametrize("shard,bits", [(2000, 16), (2, 16), (2000, 0)])
def test_substrings(spark, near_texts, shard, bits, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD", shard)
    monkeypatch.setattr(substrings, "FILTER_BITS", bits)
    if not bits:
        monkeypatch.setattr(substrings, "MOST_BITS", 64)  # a filter that passes everything changes no result
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = near_texts + [(5000 + i, " ".join([*(str(rng.random()) for _ in range(rng.randrange(20))), passage, *(str(rng.random()) for _ in range(3))])) for i in range(60)]
    rows += [(6000, "again and " * 40), (6001, "again and " * 9), (6002, "\x1f".join(["a"] * 20) + " x" * 14), (6003, "x " * 13)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, kept int").repartition(6)
    got = substrings.remove_repeats(df)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in got.collect()), key=str) == removed(rows)
    row = got.filter("doc_id = 5001").first()
    assert hashlib.sha256(row["kept"].encode()).hexdigest() == row["kept_sha256"] and sum(s["end"] - s["start"] for s in row["spans"]) == row["n_removed"]


def test_suffix_automaton_is_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        texts = [[rng.choice("abc") for _ in range(rng.randint(1, 12))] for _ in range(4)]
        automaton = substrings.SuffixAutomaton()
        owners = [rng.randrange(9) for _ in texts]
        for words, owner in zip(texts, owners):
            automaton.add(words, owner)
        asked = [rng.choice("abc") for _ in range(15)]
        for least in (1, 3):
            want = []
            for end in range(1, len(asked) + 1):
                piece = asked[end - least : end] if end >= least else None
                own = [o for w, o in zip(texts, owners) if piece and any(w[k : k + least] == piece for k in range(len(w)))]
                want.append(min(own) if own else None)
            assert automaton.statistics(asked, least) == want


@pytest.mark.parametrize("name,table,schema", [("op1_embedding_dedup", "embeddings", "vec_id long, embedding array<float>, label int"), ("op2_substring_dedup", "documents", "doc_id long, text string"), ("op4_simhash", "documents", "doc_id long, text string")])
def test_empty_tables(spark, tmp_path, name, table, schema):
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_queries_are_stable(spark, sf):
    """The registered queries over whole tables: one row for each input row, equal to the plain versions."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.QUERIES["op2_substring_dedup"](spark, sf)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept_sha256")) for r in got.collect()), key=str) == removed(docs)
    got = queries.QUERIES["op1_embedding_dedup"](spark, sf)
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted((tuple(r[c] for c in ("vec_id", "n_links", "component_id", "kept")) for r in got.collect()), key=str) == cosine_rows(rows)[0]
    assert got.filter(F.col("kept").isNull()).count() == 0
