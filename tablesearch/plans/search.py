"""Vector, text and hybrid search over the test tables."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.batch_search import nearest
from ..operators.search import IvfIndex, TextIndex, full_text_search, hybrid_search, reciprocal_rank_fusion, vector_search
from .registry import Tables, new_folder, query

_D = "list_sum(list_transform(list_zip(embedding, (SELECT embedding FROM embeddings WHERE vec_id = 7)), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))"
_P = "list_sum(list_transform(list_zip(embedding, (SELECT embedding FROM embeddings WHERE vec_id = 7)), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"
_N = "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))"
_TERMS = ("the", "of", "inea")


def _seventh(t: Tables) -> list[float]:
    """The query vector: that of vec_id 7."""
    return list(t.embeddings.filter("vec_id = 7").select("embedding").first()[0])


def _answer(found: DataFrame) -> DataFrame:
    return found.select("vec_id", "label", F.round("_distance", 9).alias("_distance"))


@query(f"SELECT vec_id, label, round({_D}, 9) AS _distance FROM embeddings ORDER BY {_D}, vec_id LIMIT 10")
def vector_search_exact(t: Tables) -> DataFrame:
    return _answer(vector_search(t.embeddings, "embedding", _seventh(t), 10))


@query(f"SELECT vec_id, label, round(1 - {_P} / ({_N} * (SELECT {_N} FROM embeddings WHERE vec_id = 7)), 9) AS _distance FROM embeddings ORDER BY 1 - {_P} / ({_N} * (SELECT {_N} FROM embeddings WHERE vec_id = 7)), vec_id LIMIT 10")
def vector_cosine(t: Tables) -> DataFrame:
    return _answer(vector_search(t.embeddings, "embedding", _seventh(t), 10, metric="cosine"))


@query(f"SELECT vec_id, label, round(1 - {_P}, 9) AS _distance FROM embeddings ORDER BY 1 - {_P}, vec_id LIMIT 10")
def vector_dot(t: Tables) -> DataFrame:
    return _answer(vector_search(t.embeddings, "embedding", _seventh(t), 10, metric="dot"))


@query(f"SELECT vec_id, label, round({_D}, 9) AS _distance FROM embeddings WHERE label = 1 ORDER BY {_D}, vec_id LIMIT 10")
def vector_prefilter(t: Tables) -> DataFrame:
    return _answer(vector_search(t.embeddings, "embedding", _seventh(t), 10, filter="label = 1", prefilter=True))


@query(f"SELECT * FROM (SELECT vec_id, label, round({_D}, 9) AS _distance FROM embeddings ORDER BY {_D}, vec_id LIMIT 100) WHERE label = 1")
def vector_postfilter(t: Tables) -> DataFrame:
    return _answer(vector_search(t.embeddings, "embedding", _seventh(t), 100, filter="label = 1"))


@query(f"SELECT * FROM (SELECT vec_id, label, round({_D}, 9) AS _distance FROM embeddings WHERE label >= 4 ORDER BY {_D}, vec_id LIMIT 50) WHERE vec_id < 400")
def vector_ns_filter(t: Tables) -> DataFrame:
    return _answer(vector_search(t.embeddings, "embedding", _seventh(t), 50, filter="label >= 4", prefilter=True, post_filter="vec_id < 400"))


@query("""SELECT query_id, vec_id, round(d, 9) AS _distance, rank FROM (SELECT q.vec_id AS query_id, v.vec_id, d, row_number() OVER (PARTITION BY q.vec_id ORDER BY d, v.vec_id) AS rank
FROM embeddings q, embeddings v, LATERAL (SELECT list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS d) WHERE q.vec_id % 100 = 0) WHERE rank <= 10""")
def vector_search_batch(t: Tables) -> DataFrame:
    """Every row whose id is divisible by 100 as a query against all rows."""
    asked = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return nearest(t.embeddings, "embedding", "vec_id", asked, "embedding", "query_id", 10).withColumn("_distance", F.round("_distance", 9))


@query()
def vector_search_ivf(t: Tables) -> DataFrame:
    """The same queries through an inverted file of 16 cells of which 12 are probed; tests hold its recall at 0.9 or more."""
    index = IvfIndex.build(t.embeddings, "embedding", "vec_id", partitions=16, path=new_folder(t))
    asked = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return index.batch_search(asked.withColumnRenamed("embedding", "query"), "query", "query_id", 10, nprobes=12)


_BM25 = """WITH tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS ts FROM documents), st AS (SELECT count(*)::DOUBLE AS n, avg(len(ts)) AS m FROM tok),
tf AS (SELECT doc_id, len(ts) AS l, q, len(list_filter(ts, lambda x: x = q))::DOUBLE AS f FROM tok, (SELECT unnest(['inea', 'of', 'the']) AS q)),
df AS (SELECT q, count(*)::DOUBLE AS d FROM tf WHERE f > 0 GROUP BY q),
sc AS (SELECT doc_id, sum(ln(1 + (n - d + 0.5) / (d + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * l / m)) ORDER BY q) AS s FROM tf JOIN df USING (q), st WHERE f > 0 GROUP BY doc_id)"""


@query(_BM25 + " SELECT doc_id, round(s, 6) AS _score FROM sc ORDER BY s DESC, doc_id LIMIT 20")
def fts_bm25(t: Tables) -> DataFrame:
    found = full_text_search(t.documents.select("doc_id", "text"), "text", " ".join(_TERMS), 20)
    return found.select("doc_id", F.round("_score", 6).alias("_score"))


@query(_BM25 + " SELECT doc_id, round(s, 6) AS _score FROM sc JOIN documents USING (doc_id) WHERE lang = 'en' AND source = 'src3' ORDER BY s DESC, doc_id LIMIT 20")
def fts_prefilter(t: Tables) -> DataFrame:
    found = full_text_search(t.documents, "text", " ".join(_TERMS), 20, filter="lang = 'en' and source = 'src3'", prefilter=True)
    return found.select("doc_id", F.round("_score", 6).alias("_score"))


@query(_BM25 + " SELECT doc_id, round(s, 6) AS _score FROM sc ORDER BY s DESC, doc_id LIMIT 20")
def fts_indexed(t: Tables) -> DataFrame:
    """fts_bm25 from a stored inverted index."""
    index = TextIndex.build(t.documents, "text", "doc_id", new_folder(t))
    return index.search(" ".join(_TERMS), 20).select("doc_id", F.round("_score", 6).alias("_score"))


@query("""SELECT query_id, vec_id, round(d, 9) AS _distance, rank FROM (SELECT q.vec_id AS query_id, v.vec_id, d, row_number() OVER (PARTITION BY q.vec_id ORDER BY d, v.vec_id) AS rank
FROM embeddings q, embeddings v, LATERAL (SELECT list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS d) WHERE q.vec_id % 100 = 0) WHERE rank <= 10""")
def vector_search_ivf_exact(t: Tables) -> DataFrame:
    """The inverted file with all cells probed gives what the exact search gives."""
    index = IvfIndex.build(t.embeddings, "embedding", "vec_id", partitions=8, path=new_folder(t))
    asked = t.embeddings.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return index.batch_search(asked, "query", "query_id", 10, nprobes=8).withColumn("_distance", F.round("_distance", 9))


_NEAR = f"near AS (SELECT vec_id AS doc_id, {_D} AS d FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents) ORDER BY d, vec_id LIMIT 40)"
_SAID = "said AS (SELECT doc_id, s FROM sc2 ORDER BY s DESC, doc_id LIMIT 40)"
_PAIRED = _BM25.replace("FROM documents)", "FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings))")


def _paired(t: Tables) -> DataFrame:
    """Documents with the vector of the same number."""
    return t.documents.join(t.embeddings, F.col("doc_id") == F.col("vec_id")).select("doc_id", "text", "embedding")


@query(_PAIRED + f""", sc2 AS (FROM sc), {_NEAR}, {_SAID}, b AS (SELECT doc_id, d, s FROM near FULL JOIN said USING (doc_id)),
r AS (SELECT min(d) AS dl, max(d) AS dh, min(s) AS sl, max(s) AS sh FROM b)
SELECT doc_id, round(CASE WHEN d IS NULL THEN 0 ELSE 0.5 * (1 - (d - dl) / (dh - dl)) END + CASE WHEN s IS NULL THEN 0 ELSE 0.5 * (s - sl) / (sh - sl) END, 6) AS _hybrid_score FROM b, r
ORDER BY CASE WHEN d IS NULL THEN 0 ELSE 0.5 * (1 - (d - dl) / (dh - dl)) END + CASE WHEN s IS NULL THEN 0 ELSE 0.5 * (s - sl) / (sh - sl) END DESC, doc_id LIMIT 10""")
def hybrid(t: Tables) -> DataFrame:
    found = hybrid_search(_paired(t), "embedding", _seventh(t), "text", " ".join(_TERMS), 10)
    return found.select("doc_id", F.round("_hybrid_score", 6).alias("_hybrid_score"))


@query(_PAIRED + f""", sc2 AS (FROM sc), {_NEAR}, {_SAID}, a AS (SELECT doc_id, row_number() OVER (ORDER BY d, doc_id) AS r FROM near), c AS (SELECT doc_id, row_number() OVER (ORDER BY s DESC, doc_id) AS r FROM said)
SELECT doc_id, round(coalesce(1 / (60.0 + a.r), 0)::DOUBLE + coalesce(1 / (60.0 + c.r), 0)::DOUBLE, 6) AS _hybrid_score FROM a FULL JOIN c USING (doc_id)
ORDER BY coalesce(1 / (60.0 + a.r), 0)::DOUBLE + coalesce(1 / (60.0 + c.r), 0)::DOUBLE DESC, doc_id LIMIT 10""")
def hybrid_rrf(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    rows = _paired(t)
    near = vector_search(rows.select("doc_id", "embedding"), "embedding", _seventh(t), 40, "doc_id").select("doc_id", F.row_number().over(Window.orderBy("_distance", "doc_id")).alias("rank"))  # 40 rows
    said = full_text_search(rows.select("doc_id", "text"), "text", " ".join(_TERMS), 40).select("doc_id", F.row_number().over(Window.orderBy(F.desc("_score"), "doc_id")).alias("rank"))  # 40 rows
    return reciprocal_rank_fusion(near, said, "doc_id", 10).withColumn("_hybrid_score", F.round("_hybrid_score", 6))
