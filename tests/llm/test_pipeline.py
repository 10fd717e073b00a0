"""The pipeline's stages, each against a plain version of it on the whole small table and on edge cases."""

import hashlib

import pyarrow as pa
import pytest

import corpus_pipeline
from tablesearch.llm import decontaminate, pii

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """The rows before and after each stage, the first table with edge cases added."""
    folder = tmp_path_factory.mktemp("stages")
    clean = "Of the and that with from this is was for are by on in to it he as be"
    extra = [(90001, None, "en", "x", 1), (90002, "", "en", "x", None), (90003, "12 34 !", None, None, None), (90004, f"{clean} mail a@b.de", None, None, 5), (90004, f"{clean} mail a@b.de", None, None, 5), (None, f"{clean} no id", "en", "x", 1), (90005, "the " * 20000, "en", "x", 1)]
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(spark.createDataFrame(extra, DOCS))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "byte_bpe"]


def test_language_stage_drops_what_has_none(stages):
    gone = {r["doc_id"] for r in stages[0].select("doc_id").subtract(stages[1].select("doc_id")).collect()}
    assert gone == {90001, 90002, 90003}
    assert stages[1].filter("doc_id = 90004").first()["lang"] == "en"


def test_duplicate_stage_keeps_one_of_each_group(stages):
    """Groups by a similarity of 0.8 of five-word shingles, every pair compared: the least row of each stays, nine tenths of the rest go."""
    before = [tuple(r) for r in stages[1].collect()]
    sets = []
    for r in before:
        words = r[1].encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    root = list(range(len(before)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(before)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for k, r in enumerate(before):
        groups.setdefault(find(k), []).append(r)
    least = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    got = rows(stages[2])
    assert {r[0] for r in least} <= {r[0] for r in got} and len(groups) < len(before)
    assert set(got) <= set(before) and len(got) - len(groups) <= 0.1 * (len(before) - len(groups))


def test_decontamination_stage(spark, sf, stages):
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    plain = lambda t: f" {' '.join(decontaminate.words_of(t))} "
    held = {r["doc_id"] for r in stages[2].collect() if any(plain(i) in plain(r["text"]) for i in items)}
    gone = {r["doc_id"] for r in stages[2].collect()} - {r["doc_id"] for r in stages[3].collect()}
    assert held <= gone
    texts = {r["doc_id"]: decontaminate.runs(decontaminate.words_of(r["text"])) for r in stages[2].collect()}
    assert all(any(len(texts[d] & decontaminate.runs(decontaminate.words_of(i))) >= 0.4 * len(decontaminate.runs(decontaminate.words_of(i))) for i in items) for d in gone)


def test_pii_stage(stages):
    want = []
    for r in stages[3].collect():
        text = pii.redact(r["text"], pii.find_spans(r["text"]))
        want.append((*tuple(r)[:1], text, *tuple(r)[2:4], len(text)))
    assert rows(stages[4]) == sorted(want, key=str)
    assert "[EMAIL]" in stages[4].filter("doc_id = 90004").first()["text"]


def test_bpe_stage(stages):
    texts = sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in stages[4].collect())
    assert sorted(r["decoded_sha256"] for r in stages[5].collect()) == texts


def test_run_is_the_stages(spark, sf):
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_reach_python_in_small_batches(spark, sf):
    """12 MB in one partition: a stage's rows were one batch; a size that the user set stays."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["bytes"])

    docs = spark.range(3000, numPartitions=1).selectExpr("id as doc_id", "repeat('some words ', 400) as text", "'en' as lang", "'x' as source", "4400L as n_chars")
    largest = lambda: max(r["bytes"] for r in dict(corpus_pipeline.STAGES)["pii"](spark, docs, sf).mapInArrow(sizes, "bytes long").collect())
    for own, low, high in ((None, 1 << 20, 3 << 20), ("6m", 5 << 20, 7 << 20)):
        spark.conf.unset(corpus_pipeline.BATCH_KEY)
        if own:
            spark.conf.set(corpus_pipeline.BATCH_KEY, own)
        assert low < largest() < high
    spark.conf.unset(corpus_pipeline.BATCH_KEY)
