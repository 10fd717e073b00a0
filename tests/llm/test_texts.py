"""Language ID, toxicity, decontamination and personal data: plain versions, held-out accuracy and planted cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesearch.llm import decontaminate, langid, pii, queries, toxicity
from tablesearch.llm._common import fold

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_folds(spark):
    got = {r["i"]: r["f"] for r in spark.range(200).select(F.col("id").alias("i"), fold("id", 3).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 for i in range(200)}


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op5_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and 200 < len(held) < 500
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    rows = [(i, f"the cat sat on the mat number {'abc'[i % 3]}", "en", None, 1) for i in range(30)] + [(100 + i, "die katze sitzt auf der matte", "de", "s", None) for i in range(30)]
    rows += [(900, None, "en", None, None), (901, "", None, None, None), (902, "123 !!! ☃", "en", None, None), (None, "die katze", None, None, None), (903, "THE MAT " * 20000, "de", "x", 1), (903, "the mat", "", "x", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.fit(docs.filter("doc_id < 200"))
    assert model.languages == ["de", "en"]
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(docs, model).filter("doc_id >= 900 or doc_id is null").collect()), key=str)
    assert [(i, p) for i, p, _ in got] == [(900, "und"), (901, "und"), (902, "und"), (903, "en"), (903, "en"), (None, "de")]
    assert [s for i, p, s in got if p == "und"] == [0.0] * 3
    assert langid.Scorer(model).predict(["katzen"])[0][0] == "de"  # unseen: by its pieces
    empty = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}
    kept = langid.keep_known(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.count() == 63 and kept.filter("doc_id is null").first()["lang"] == "de"


def test_language_of_few_texts_in_many_copies(spark):
    """A language of few texts in many copies is learnt, and a text in many copies counts once in its language."""
    own = spark.range(60_000).select(F.concat(F.lit("the house number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    copies = spark.range(30_000).select(F.lit("die katze sitzt auf der matte").alias("text"), F.lit("de").alias("lang"))
    hot = spark.range(30_000).select(F.lit("zzz zzz zzz").alias("text"), F.lit("en").alias("lang"))
    for sample in (2, 50, 2000):
        model = langid.fit(own.union(copies).union(hot), sample_docs=sample)
        assert model.languages == ["de", "en"]
        assert model.words["the"][1] > model.words.get("zzz", model.unseen)[1] + 3


def plain_languages(learn, texts):
    """The model and its scores without Spark and arrays: words by log frequency, else the mean of the longest known n-grams."""
    words = {}
    for lang, text in sorted(set(learn)):
        words.setdefault(lang, Counter()).update(langid.words_of(text))
    langs = sorted(words)
    grams = {lang: Counter() for lang in langs}
    for lang in langs:
        for w, n in words[lang].items():
            for size in range(1, 5):
                for i in range(len(w) + 2 - size + 1):
                    grams[lang][f"_{w}_"[i : i + size]] += n
    known = {w for lang in langs for w, n in words[lang].items() if n > 1}
    total = {lang: sum(words[lang].values()) for lang in langs}
    per = {(lang, size): sum(n for g, n in grams[lang].items() if len(g) == size) for lang in langs for size in range(1, 5)}

    def score(word, lang):
        if word in known:
            return math.log(((words[lang][word] if words[lang][word] > 1 else 0) + 0.5) / (total[lang] + 1))
        found, marked = [], f"_{word}_"
        for i in range(len(marked)):
            size = next((s for s in range(min(4, len(marked) - i), 0, -1) if any(marked[i : i + s] in grams[x] for x in langs)), 0)
            if size:
                found.append(math.log((grams[lang][marked[i : i + size]] + 0.5) / (per[lang, size] + 1)))
        return sum(found) / len(found) if found else math.log(0.5) - math.log(total[lang] + 1)

    for text in texts:
        own = langid.words_of(text or "")
        if not own:
            yield "und", 0.0
            continue
        sums = {lang: sum(score(w, lang) for w in own) / len(own) * min(len(own), langid.EVIDENCE) for lang in langs}
        best = max(langs, key=lambda x: sums[x])
        yield best, 1 / sum(math.exp(v - sums[best]) for v in sums.values())


def test_language_is_brute_force(spark, sf):
    """The whole query on the small table against a plain version, scores too; an empty language is one like any other."""
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(5000 + i, t, "") for i, t in enumerate(["zq xqx zzq", "xqx qqz zq zq", "qzq xqx"] * 3)] + [(6000, None, "en"), (6001, "12 !", "en"), (6002, "zq zqq", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = [(lang, t) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1 and t is not None and lang is not None]
    want = {i: p for (i, _, _), p in zip(rows, plain_languages(learn, [t for _, t, _ in rows]))}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, langid.fit(docs.filter(fold("doc_id", 3) != 1), most_words=10**9, most_grams=10**9)).collect()}
    assert {i: p for i, (p, _) in got.items()} == {i: p for i, (p, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-4 for i in want)
    assert got[6002][0] == ""


def test_most_frequent_words_of_each_language(spark):
    counts = spark.createDataFrame([(lang, f"w{n}{k}", n) for lang in "ab" for n in (1, 2, 3) for k in range(n if lang == "a" else 4)], "lang string, word string, n long")
    kept = lambda most: sorted((r["lang"], r["n"]) for r in langid._frequent(counts, most).select("lang", "n").distinct().collect())
    assert kept(5) == [("a", 2), ("a", 3), ("b", 3)] and kept(100) == [(x, n) for x in "ab" for n in (1, 2, 3)] and kept(1) == [("a", 3), ("b", 3)]


def test_toxicity_of_few_texts_in_many_copies(spark):
    """All copies of the one toxic text are in one part of the fit: on either side it is learnt."""
    docs, labels = planted(2, 400)
    for bad in ("mugwort dretchy", "vileskum grobnak", "grobnak mugwort", "dretchy vileskum"):
        text = f"tari {bad} ri mon el {bad[::-1]} sha ke {bad} mon ri"
        rows = [(t, 0) for (_, t), (_, y) in zip(docs, labels) if not y] + [(text, 1)] * 90
        model = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
        got = {r["doc_id"]: r["predicted"] for r in toxicity.score(spark.createDataFrame([(1, text), (2, "tari ri mon el sha ke")], "doc_id long, text string"), model).collect()}
        assert got == {1: 1, 2: 0}


def planted(seed=0, n=900):
    """Ordinary prose, of which a tenth has words that nobody else uses."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ta", "ri", "mon", "el", "sha", "ke"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["grobnak", "vileskum", "dretchy", "mugwort"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        toxic = int(i % 10 == 0)
        for _ in range(rng.randint(1, 4) * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return docs, labels


def test_toxicity_of_planted_documents(spark):
    docs, labels = planted()
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_held_out(d, l).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == {i for i, _ in held}
    assert sum(got[i]["predicted"] == y for i, y in held) / len(held) > 0.97
    assert sum(got[i]["predicted"] for i, y in held if y) >= 0.8 * sum(y for _, y in held)


def test_toxicity_of_many_rare_words(spark):
    """400 toxic words, each in under 1 % of the toxic rows; a third are of three letters, a third of two CJK characters."""
    rng = random.Random(5)
    words = ["".join(rng.choice(["ta", "ri", "mon", "el", "sha", "ke"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    letters = lambda n: "".join(rng.choice("bdfgjpquvwxyz") for _ in range(n))
    bad = sorted({[letters(8), letters(3), "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(2))][k % 3] for k in range(400)})
    docs, labels, seen = [], [], {}
    for i in range(7500):
        text = [rng.choice(words) for _ in range(rng.randint(10, 30))]
        for w in rng.sample(bad, 3) if i % 3 == 0 else ():
            text.insert(rng.randrange(len(text)), w)
            seen[w] = seen.get(w, 0) + 1
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 3 == 0)))
    assert len(seen) > 300 and sum(n / 2500 < 0.01 for n in seen.values()) > 0.8 * len(seen) and max(seen.values()) / 2500 < 0.02
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_held_out(d, l).filter("held_out").collect()}
    toxic = [got[i] for i, y in labels if i in got and y]
    clean = [got[i] for i, y in labels if i in got and not y]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.05


def test_toxicity_edges(spark):
    docs, labels = planted(1, 300)
    docs += [(1000, None), (1001, ""), (1002, "tari " * 30000), (1002, "x"), (None, "ri mon")]
    labels += [(1000, None), (1001, 0), (7777, 1), (3, labels[3][1]), (None, 1)]
    d, l = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_held_out(d, l)
    assert got.count() == len(docs) and got.filter("score is null or score < 0 or score > 1 or (score >= 0.5) <> (predicted = 1)").count() == 0
    assert toxicity.score_held_out(d.limit(0), l).count() == 0
    for some in (l.limit(0), l.filter("toxic = 0"), l.filter("toxic = 1")):
        assert toxicity.score_held_out(d, some).count() == len(docs)


def test_block_max_search_is_brute_force():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(rng.choice(words[: rng.choice([20, 120])]) for _ in range(rng.randint(3, 100)))) for i in range(90)]
    df = {}
    for _, t in items:
        for w in set(decontaminate.words_of(t)):
            df[w] = df.get(w, 0) + 1
    index = decontaminate.build(items, decontaminate._Idf(df, len(items)))
    for _ in range(60):
        query = {rng.choice(words) for _ in range(rng.randint(1, 60))}
        want = {}
        for w in query & set(index.terms):
            for part, weight in zip(*index.postings[index.terms[w]]):
                want[int(part)] = want.get(int(part), 0.0) + weight
        terms = sorted(index.terms[w] for w in query if w in index.terms)
        for threshold in (0.05, 0.3, 0.6):
            got = {p: s for b in range(index.bounds.shape[1]) for p, s in index.search(terms, b, threshold).items()}
            assert set(got) == {p for p, s in want.items() if s >= threshold} and all(abs(got[p] - want[p]) < 1e-9 for p in got)


def test_leaks(spark, sf):
    """Every item that stands in a text word for word is found, and nothing that shares under half of its word runs."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    got = queries.QUERIES["op8_decontamination"](spark, "/root/testdata/sf0.01").collect()
    plain = lambda t: " ".join(decontaminate.words_of(t))
    texts = [(i, plain(t)) for i, t in docs]
    whole = {(d, i) for i, t in bench for d, x in texts if f" {plain(t)} " in f" {x} "}
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert whole and whole <= pairs
    runs = {i: decontaminate.runs(decontaminate.words_of(t)) for i, t in bench}
    own = {d: decontaminate.runs(x.split()) for d, x in texts}
    assert all(len(runs[i] & own[d]) >= 0.4 * len(runs[i]) for d, i in pairs)


def test_leak_edges(spark):
    question = "Which of the nine moons of the small blue planet was first seen by the keeper of the northern light? Answer: the copper moon"
    long_item = " ".join(f"term{i}" for i in range(300))
    bench = spark.createDataFrame([(1, question), (2, None), (3, ""), (4, long_item), (None, "quite another item about winter wheat and barley"), (1, question)], "item_id long, text string")
    noise = " ".join(f"noise{i}" for i in range(500))
    docs = spark.createDataFrame([(1, f"{noise} {question.upper()} {noise}", 1), (2, question.split(" Answer")[0], 1), (3, None, 1), (4, "", 1), (5, f"{noise} {long_item} {noise}", 1), (5, long_item, 1), (6, noise * 50, 1), (None, "Quite another ITEM, about winter wheat and barley.", 1)], "doc_id long, text string, item_id int")
    got = decontaminate.find_leaks(docs.repartition(3), bench)
    assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=str) == sorted([(1, 1), (5, 4), (5, 4), (None, None)], key=str)
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    left = decontaminate.drop_leaks(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4, 6] and left.columns == docs.columns


def test_leaks_of_plain_items_in_part(spark):
    """Items without a marked answer: one edited word, a missing last sentence, a colon that marks no answer, half of the words."""
    first = " ".join(f"moon{i}" for i in range(14))
    bench = [(1, f"{first}. The keeper saw copper."), (2, f"Formula: {' '.join(f'wheat{i}' for i in range(12))}. Vitamin A: barley rises."), (3, f"{' '.join(f'river{i}' for i in range(20))}. Stone.")]
    noise = " ".join(f"noise{i}" for i in range(100))
    texts = {
        1: bench[0][1].replace("saw", "found"),
        2: f"{first}.",
        3: bench[1][1].replace("Vitamin", "mineral"),
        4: bench[1][1].split(". Vitamin")[0],
        5: bench[2][1].rsplit(". ", 1)[0],
        6: " ".join(bench[2][1].split()[:14]),
        7: " ".join(bench[2][1].split()[:8]),
        8: "Formula: the keeper saw copper. Vitamin A: barley rises. Stone.",
    }
    docs = spark.createDataFrame([(i, f"{noise} {t} {noise}") for i, t in texts.items()], "doc_id long, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 3)]


def test_marked_answers():
    split = lambda t: tuple(" ".join(p) for p in decontaminate.question_and_answer(t))
    for marked in ("Who came? Answer: the king", "Who came\nANSWER : the king", "Who came? A: the king", "Who came\n a: the king"):
        assert split(marked) == ("who came", "the king")
    for whole in ("Formula: one. Two three.", "Vitamin A: one two", "Answer: one two", "One two. Three"):
        assert split(whole) == (" ".join(decontaminate.words_of(whole)),) * 2


def test_leaks_of_a_benchmark_in_many_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 60)
    items = [(i, " ".join(f"a{i}b{k}" for k in range(12))) for i in range(9)]
    docs = spark.createDataFrame([(i, f"x y z {t} z y x") for i, t in items], "doc_id long, text string")
    got = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(i, i) for i in range(9)]


def plain_leaks(docs, items):
    """Every passage against every part of every item by plain BM25, then the overlap of the runs."""
    parts = [(i, p) for i, t in items for p in decontaminate.parts_of(decontaminate.words_of(t))]
    mean = sum(len(p) for _, p in parts) / len(parts)
    holds = [set(decontaminate.words_of(t)) for _, t in items]
    idf = lambda w: math.log(1 + (len(items) - sum(w in h for h in holds) + 0.5) / (sum(w in h for h in holds) + 0.5))
    rare = {w: idf(w) for h in holds for w in h}
    weighed = []
    for i, p in parts:
        w = {t: rare[t] * p.count(t) * 2.2 / (p.count(t) + 1.2 * (0.25 + 0.75 * len(p) / mean)) for t in set(p)}
        weighed.append((i, {t: x / sum(w.values()) for t, x in w.items()}))
    texts = dict(items)
    out = set()
    for d, text in docs:
        words = decontaminate.words_of(text)
        for at in range(0, max(1, -(-len(words) // 24) - 1) * 24, 24):
            passage = set(words[at : at + 48])
            for i, w in weighed:
                if (d, i) not in out and sum(w[t] for t in passage & set(w)) >= decontaminate.RETRIEVE:
                    q, a = map(decontaminate.runs, decontaminate.question_and_answer(texts[i]))
                    held = {tuple(words[k : k + n]) for n in {len(r) for r in q | a} for k in range(len(words) - n + 1)}
                    if len(q & held) >= len(q) / 2 and len(a & held) >= len(a) / 2:
                        out.add((d, i))
    return out


@pytest.mark.parametrize("index_bytes", [1 << 20, 2000])
def test_leaks_are_brute_force(spark, sf, monkeypatch, index_bytes):
    """Whole and altered items in other text, end to end; the split into indexes changes nothing."""
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", index_bytes)
    monkeypatch.setattr(decontaminate, "INDEXES", 3)
    rng = random.Random(8)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(5000 + i, " ".join(f"q{rng.randrange(60)}" for _ in range(rng.randint(3, 120))) + f"? Answer: the a{i} b{i % 3} c") for i in range(20)]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    for n in range(120):
        words = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 1, 3, 10, 30])):
            words[rng.randrange(len(words))] = f"other{rng.randrange(50)}"
        begin = rng.choice([0, 0, len(words) // 3])
        docs.append((10_000 + n, " ".join([*rng.choice(docs)[1].split()[: rng.randrange(80)], *words[begin : begin + rng.randint(5, 130)], *rng.choice(docs)[1].split()[:30]])))
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = plain_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) > 40


@pytest.mark.parametrize("kind", ["short", "double", "string"])
def test_leaks_of_items_with_ids_of_any_type(spark, kind):
    bench = spark.createDataFrame([(7, "quite another item about winter wheat and barley")], "item_id int, text string").withColumn("item_id", F.col("item_id").cast(kind))
    docs = spark.createDataFrame([(3, "here is quite another item about winter wheat and barley")], "doc_id int, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = decontaminate.find_leaks(docs, bench)
    assert [(float(r["doc_id"]), float(r["item_id"])) for r in got.collect()] == [(3.0, 7.0)] and got.schema["item_id"].dataType == bench.schema["item_id"].dataType
    assert decontaminate.drop_leaks(docs, bench).count() == 0


TEXTS = [
    "mail a.b+c@x-y.co.uk, or a@b@c.de; bad@nodot; x@y..z; @start.de; _%+-@q.r.s",
    "ips 1.2.3.4 256.1.1.1 1.2.3.4.5 001.002.003.004 1.2.3 999.1.2.3.4",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1112 378282246310005 5555555555554444 0000000000000 4111  1111",
    "phones +49 (30) 123-4567 +1 +123456789012345678 +44.20.7946.0958x + 12 +9-99",
    "call my phone 212-555-0187 now; order 212-555-0188; ssn 078-05-1120, version 078-05-1121",
    "iban DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01, GB82WEST12345698765432",
    "ünïcödé vor a@b.de \U0001f600\U0001f600 1.2.3.4",
    "",
    None,
    "1" * 50000 + "@" + "a." * 20000 + "b",
    "4111111111111111@1.2.3.4 +4111111111111111.5",
]


def base_by_patterns(text):
    out = []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split(".") if len(p) < 4000) and all(len(p) < 4000 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [f"{pii.BASE[k]}:{s}:{e}" for s, k, e in sorted(out)]


def test_personal_data(spark, sf):
    own = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    rng = random.Random(8)
    made = ["".join(rng.choice(["@", ".", "a", "b-", "+", "1", "23", "4111111111111111", " ", "-", "(", "é", "x@y.z", "1.2.3.4"]) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    rows = [*enumerate(own + made + TEXTS), (1, own[1]), (None, TEXTS[0])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int")
    want = []
    for i, t in rows:
        base = base_by_patterns(t or "")
        want.append((i, *(sum(b.startswith(f"{k}:") for b in base) for k in pii.BASE), hashlib.sha256(",".join(base).encode()).hexdigest()))
    got = pii.find_pii(docs)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) for r in got.collect()), key=str) == sorted(want, key=str)
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_personal_data_takes_time_in_proportion():
    import time

    begun = time.time()
    for text in ("1" * 1_000_000 + ".", "0" * 1_000_000 + ".1.2.3", "1." * 500_000, "a@" * 500_000, "+1" + "(" * 1_000_000, "a" * 1_000_000 + "@", "1 " * 500_000):
        pii.find_spans(text)
    assert time.time() - begun < 30
    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [(0, 5007, "ip")]


def test_checksums_and_context():
    kinds = lambda t: [(k, t[s:e]) for s, e, k, _ in pii.find_spans(t)]
    assert kinds(TEXTS[4]) == [("local_phone", "212-555-0187"), ("ssn", "078-05-1120")]
    assert [x for x in kinds(TEXTS[5]) if x[0] == "iban"] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.mod97("DE89370400440532013000")
    assert pii.redact("x a@b.de y", pii.find_spans("x a@b.de y")) == "x [EMAIL] y"


def test_redaction_keeps_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.de", "x"), (None, None, None), (1, "a@b.de", "x"), (2, "clean", "x")], "doc_id long, text string, redacted string")
    got = pii.redact_pii(docs)
    assert got.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"], r["redacted"]) for r in got.collect() if r["text"]) == [("1", "[EMAIL]", "x"), ("1", "[EMAIL]", "x"), ("2", "clean", "x")] and got.count() == 4


@pytest.mark.parametrize("name", ["op5_language_id", "op6_toxicity", "op8_decontamination", "op9_pii"])
def test_empty_tables(spark, tmp_path, name):
    for table, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
