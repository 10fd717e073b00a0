"""Search semantics on small rows."""

import pytest

from tablesearch.functions.distances import checked_vector
from tablesearch.functions.text import regex_full_match, regex_matches
from tablesearch.operators.search import IvfIndex, full_text_search, hybrid_search, vector_search


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 0, "a puppy and a dog", [0.0, 0.0, 0.0, 1.0]), (2, 1, "no cat", [0.0, 0.0, 1.0, 0.0]), (3, 1, "puppy puppy", [0.0, 1.0, 0.0, 0.0]), (4, 0, None, None), (5, 1, "", [1.0, 0.0])]
    return spark.createDataFrame(rows, "id long, label int, text string, vec array<float>")


def got(df, column):
    return [(r["id"], None if r[column] is None else round(r[column], 6)) for r in df.collect()]


def test_vector_search(table):
    q = [0.0, 0.0, 0.0, 1.0]
    assert got(vector_search(table, "vec", q, 5, "id"), "_distance") == [(1, 0.0), (2, 2.0), (3, 2.0)]
    assert got(vector_search(table, "vec", q, 1, "id", filter="label = 1", prefilter=True), "_distance") == [(2, 2.0)]
    assert got(vector_search(table, "vec", q, 1, "id", filter="label = 1"), "_distance") == []
    assert got(vector_search(table, "vec", q, 2, "id", metric="cosine"), "_distance") == [(1, 0.0), (2, 1.0)]


def test_full_text_statistics_are_the_table_s(table):
    all_rows = dict(got(full_text_search(table, "text", "Puppy", 5, "id"), "_score"))
    assert list(all_rows) == [3, 1]
    assert got(full_text_search(table, "text", "puppy", 5, "id", filter="label = 1", prefilter=True), "_score") == [(3, all_rows[3])]
    assert got(full_text_search(table, "text", "puppy", 1, "id", filter="label = 0"), "_score") == []


def test_hybrid_counts_a_missing_side_as_nothing(table):
    found = {r["id"]: r for r in hybrid_search(table, "vec", [0.0, 0.0, 0.0, 1.0], "text", "puppy", 5, "id", alpha=0.5).collect()}
    assert round(found[1]["_hybrid_score"], 6) == 0.5 and round(found[3]["_hybrid_score"], 6) == 0.5
    assert found[2]["_score"] is None and found[2]["_hybrid_score"] == 0.0


def test_wrong_arguments(table):
    for vector in ([], None, [float("nan")], ["x"], [1e39]):
        with pytest.raises(ValueError):
            checked_vector(vector)
    for call in (lambda: vector_search(table, "vec", [1.0], 0, "id"), lambda: vector_search(table, "vec", [1.0], 1, "id", metric="x"), lambda: full_text_search(table, "text", " !", 1, "id"), lambda: regex_matches("text", "a", "x")):
        with pytest.raises(ValueError):
            call()


def test_regex(table):
    assert table.filter(regex_full_match("text", "PUPPY puppy", "i")).count() == 1
    assert table.filter(regex_full_match("text", "puppy")).count() == 0


def test_ivf_with_all_cells_is_exact(spark):
    import random

    rng = random.Random(1)
    rows = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)], "id long, vec array<double>")
    index = IvfIndex.build(rows, "vec", "id", partitions=8)
    q = [0.1] * 8
    assert got(index.search(q, 10, nprobes=8), "_distance") == got(vector_search(rows, "vec", q, 10, "id"), "_distance")
    assert index.assigned.count() == 300


@pytest.mark.parametrize("metric", ["l2", "cosine", "dot"])
def test_ivf_batches_are_the_single_searches(spark, metric, monkeypatch):
    """All cells probed, in parts and blocks: bit for bit what one search a query gives, ties by id; pairs are not sent out."""
    import random

    from tablesearch.operators import search

    rng = random.Random(2)
    rows = [(i, [rng.gauss(3, 1) for _ in range(8)]) for i in range(300)] + [(400 + i, [1.0] * 8) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    index = IvfIndex.build(df, "vec", "id", partitions=4, metric=metric)
    asked = spark.createDataFrame([(i, v) for i, v in rows if i % 60 == 0] + [(900, [1.0] * 3), (901, None), (902, [None] * 8)], "query long, q array<double>")
    monkeypatch.setattr(search, "PART_ROWS", 30)
    monkeypatch.setattr(search, "QUERY_BLOCK", 4)
    found = index.batch_search(asked, "q", "query", 5, nprobes=4)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()
    got = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["id"], r["_distance"]))
    want = {i: [(r["id"], r["_distance"]) for r in vector_search(df, "vec", v, 5, "id", metric).collect()] for i, v in rows if i % 60 == 0}
    assert got == want


def test_postings_are_counted_row_by_row(spark, tmp_path, monkeypatch):
    """No shuffle; rows of one id and length count apart, as bm25 counts them; null and empty texts have none."""
    from collections import Counter

    from tablesearch.operators import search

    rows = [(1, "a b a"), (1, "b b c"), (2, None), (3, ""), (4, "É é x " * 50), (5, "A")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    plan = search.postings(spark.createDataFrame(rows, "id long, text string"), "text", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    want = sorted((w, i, len(t.split()), n) for i, t in rows if t for w, n in Counter(t.lower().split()).items())
    got = search.postings(df, "text", "id").collect()
    assert sorted((r["token"], r["id"], r["length"], r["tf"]) for r in got) == want
    index = search.TextIndex.build(df, "text", "id", str(tmp_path / "index"))
    whole = {}
    for r in search.bm25(df, "text", "b c", "id").collect():
        whole[r["id"]] = whole.get(r["id"], 0.0) + r["_score"]
    assert {r["id"]: round(r["_score"], 9) for r in index.scores("b c").collect()} == {i: round(s, 9) for i, s in whole.items()}
