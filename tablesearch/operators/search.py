"""Vector, full-text and hybrid search: each returns the rows of a table with a score column, best first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distances import distance, vector_literal
from ..functions.text import tokens

#: BM25's usual constants.
K1, B = 1.2, 0.75
#: Rows of a part of a cell and queries of a block that meet in one task, about.
PART_ROWS, QUERY_BLOCK = 100_000, 8192


def _positive(**values: int | None) -> None:
    for name, value in values.items():
        if value is not None and value <= 0:
            raise ValueError(f"{name} must be positive")


def vector_search(table: DataFrame, vector_col: str, query: Sequence[float], k: int = 10, id_col: str = "vec_id", metric: str = "l2", filter: Column | str | None = None, prefilter: bool = False, post_filter: Column | str | None = None) -> DataFrame:
    """The k nearest rows with _distance, nearest first, ties by id_col.

    filter with prefilter=True narrows the rows before the k are taken; post_filter (and filter without prefilter) after.
    Each task keeps its k best; the table is read once and nothing is shuffled but those. Null vectors, and those of
    another length, are never found.
    """
    _positive(k=k)
    rows = table
    if filter is not None and prefilter:
        rows = rows.filter(filter)
    found = rows.withColumn("_distance", distance(vector_col, vector_literal(query), metric)).filter("_distance is not null")
    found = found.orderBy("_distance", id_col).limit(k)
    for condition in (filter if not prefilter else None, post_filter):
        if condition is not None:
            found = found.filter(condition)
    return found


class IvfIndex:
    """An inverted-file index: rows dealt to their nearest centroid, written and read by centroid.

    The centroids are fitted to a bounded sample (`sample` rows, by hash of the id); every row is indexed. With a path the rows
    are written there once, a folder for each cell, and a search reads the folders it probes only.
    """

    def __init__(self, assigned: DataFrame, centroids: list[list[float]], vector_col: str, id_col: str, metric: str, cell: str):
        self.assigned, self.centroids, self.vector_col, self.id_col, self.metric, self.cell = assigned, centroids, vector_col, id_col, metric, cell

    @classmethod
    def build(cls, table: DataFrame, vector_col: str, id_col: str, partitions: int = 256, metric: str = "l2", sample: int = 100_000, iterations: int = 20, seed: int = 42, path: str | None = None) -> IvfIndex:
        _positive(num_partitions=partitions, max_iterations=iterations)
        features, cell = (next(f"{n}{i or ''}" for i in range(len(table.columns) + 1) if f"{n}{i or ''}" not in table.columns) for n in ("features", "cell"))
        total = table.count()
        rate = min(1.0, sample / max(1, total))
        points = table.withColumn(features, array_to_vector(F.transform(vector_col, lambda x: x.cast("double"))))
        picked = points.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 32)) < int(rate * (1 << 32))).select(features)
        means = KMeans(featuresCol=features, predictionCol=cell, k=min(partitions, max(2, int(total * rate))), maxIter=iterations, seed=seed, distanceMeasure="cosine" if metric == "cosine" else "euclidean").fit(picked)
        assigned = means.transform(points).drop(features)
        if path is not None:
            # Rows of a cell are dealt to several tasks, so that a large cell is no single one.
            assigned.repartition(cell, F.pmod(F.xxhash64(id_col), F.lit(8))).write.partitionBy(cell).parquet(path)
            assigned = table.sparkSession.read.schema(assigned.schema).parquet(path)
        return cls(assigned, [c.tolist() for c in means.clusterCenters()], vector_col, id_col, metric, cell)

    def probed(self, query: Sequence[float], nprobes: int) -> list[int]:
        """The cells whose centroids are nearest to the query; the centroids are few and on the driver."""
        import numpy as np

        _positive(nprobs=nprobes)
        c, q = np.array(self.centroids), np.array(query, float)
        if self.metric == "l2":
            d = ((c - q) ** 2).sum(axis=1)
        else:
            d = 1 - c @ q / (np.linalg.norm(c, axis=1) * np.linalg.norm(q) if self.metric == "cosine" else 1)
        return [int(i) for i in np.argsort(d, kind="stable")[:nprobes]]

    def search(self, query: Sequence[float], k: int = 10, nprobes: int = 16, refine_factor: int | None = None, filter: Column | str | None = None) -> DataFrame:
        """The k nearest rows of the nprobes nearest cells, measured exactly. refine_factor takes k times as many before a
        filter that follows the search; exact distances need no other refinement."""
        _positive(refine_factor=refine_factor)
        rows = self.assigned.filter(F.col(self.cell).isin(self.probed(query, nprobes))).drop(self.cell)
        found = vector_search(rows, self.vector_col, query, k * (refine_factor or 1), self.id_col, self.metric)
        found = found if filter is None else found.filter(filter)
        return found.orderBy("_distance", self.id_col).limit(k) if refine_factor else found

    def batch_search(self, queries: DataFrame, query_col: str, query_id: str, k: int = 10, nprobes: int = 16) -> DataFrame:
        """The k nearest rows for each row of queries: query_id, id_col, _distance, rank. Queries are sent to the cells they
        probe. A cell is dealt to parts by a hash of the row, of PART_ROWS at most, and the queries to blocks of about
        QUERY_BLOCK; a part meets a block in one task, which keeps the k best of each query and gives no other pairs."""
        from pyspark.sql import Window

        from .batch_search import nearest_in_cell

        centroids = F.array(*[F.struct(F.lit(i).alias("cell"), F.array(*[F.lit(float(x)) for x in c]).alias("c")) for i, c in enumerate(self.centroids)])
        by = F.transform(centroids, lambda s: F.struct(distance(s["c"], F.col("_q"), self.metric).alias("d"), s["cell"].alias("cell")))
        parts, blocks = max(8, -(-self.assigned.count() // PART_ROWS)), max(1, -(-queries.count() // QUERY_BLOCK))
        dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        asked = queries.select(F.col(query_id).alias("_query"), F.transform(query_col, lambda x: x.cast("double")).alias("_q"))
        probes = asked.select("_query", "_q", F.explode(F.slice(F.array_sort(by), 1, nprobes)).alias("p")).select("_query", "_q", F.col("p.cell").alias("_cell"), dealt("_query", blocks).alias("_block"), every(parts).alias("_part"))
        rows = self.assigned.select(F.col(self.id_col).alias("_id"), F.col(self.vector_col).alias("_v"), F.col(self.cell).alias("_cell")).withColumn("_part", dealt("_id", parts)).withColumn("_block", every(blocks))
        key, types = ["_cell", "_part", "_block"], {f.name: f.dataType.simpleString() for f in [asked.schema["_query"], rows.schema["_id"]]}
        best = rows.groupBy(*key).cogroup(probes.groupBy(*key)).applyInArrow(nearest_in_cell(k, self.metric), f"_query {types['_query']}, _id {types['_id']}, _distance double")
        ranked = best.withColumn("_r", F.row_number().over(Window.partitionBy("_query").orderBy("_distance", "_id"))).filter(F.col("_r") <= k)
        return ranked.select(F.col("_query").alias(query_id), F.col("_id").alias(self.id_col), "_distance", F.col("_r").alias("rank"))


#: Tokens counted at a time in a task; a longer text is counted alone.
TOKENS = 1 << 20


def _counted(batches):
    """Rows with their tokens -> a row for each distinct token of each."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.list_value_length(batch.column("tokens")).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + TOKENS, side="right")))
            part, size = batch.slice(start, stop - start), lengths[start:stop]
            words = pc.list_flatten(part.column("tokens")).dictionary_encode()
            if len(words):
                pairs, tf = np.unique(np.repeat(np.arange(len(size)), size) * len(words.dictionary) + words.indices.to_numpy(), return_counts=True)
                row, word = np.divmod(pairs, len(words.dictionary))
                yield pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(word)), part.column(1).take(pa.array(row)), pa.array(size[row].astype(np.int32)), pa.array(tf)], ["token", batch.schema.names[1], "length", "tf"])
            start = stop


def postings(table: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """The inverted index of a text column: token, id_col, length (tokens of the row), tf. A row's tokens are counted where the
    row is read; nothing is shuffled."""
    rows = table.select(tokens(text_col).alias("tokens"), id_col)
    return rows.mapInArrow(_counted, f"token string, `{id_col}` {rows.schema[id_col].dataType.simpleString()}, length int, tf long")


class TextIndex:
    """A stored inverted index: postings in segments, each in order of token, and the number of rows and tokens. A search reads
    the postings of its terms (Parquet ranges leave the others of a segment out) and no text."""

    def __init__(self, spark, path: str, id_col: str):
        self.spark, self.path, self.id_col = spark, path, id_col

    @classmethod
    def build(cls, table: DataFrame, text_col: str, id_col: str, path: str) -> TextIndex:
        """A task's rows are a segment, so a token in a third of all rows is in many files, not one. Null texts have no tokens."""
        postings(table, text_col, id_col).sortWithinPartitions("token", id_col).write.parquet(f"{path}/postings")
        held = table.sparkSession.read.parquet(f"{path}/postings").agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("tokens"))  # one row; texts are not split again
        sizes = table.agg(F.count("*").alias("n")).crossJoin(F.broadcast(held))
        sizes.select("n", F.when(F.col("n") > 0, F.col("tokens") / F.col("n")).alias("mean")).coalesce(1).write.parquet(f"{path}/statistics")
        return cls(table.sparkSession, path, id_col)

    def scores(self, query: str) -> DataFrame:
        """id_col and _score, as bm25 gives them."""
        terms = sorted(set(_terms(self.spark, query)))
        if not terms:
            raise ValueError("query must have a term")
        held = self.spark.read.parquet(f"{self.path}/postings").filter(F.col("token").isin(terms))
        stats = self.spark.read.parquet(f"{self.path}/statistics").first()
        df = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}  # a row a term
        if not df:
            return held.select(self.id_col, F.lit(0.0).alias("_score"))
        idf = F.create_map(*[x for t, n in df.items() for x in (F.lit(t), F.log(1 + (F.lit(stats["n"]) - n + F.lit(0.5)) / (F.lit(n) + F.lit(0.5))))])[F.col("token")]
        tf = F.col("tf").cast("double")
        part = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(stats["mean"])))
        return held.select(self.id_col, part.alias("_part")).groupBy(self.id_col).agg(F.sum("_part").alias("_score"))

    def search(self, query: str, k: int = 10) -> DataFrame:
        """id_col and _score of the k best rows, best first, ties by id."""
        _positive(k=k)
        return self.scores(query).orderBy(F.desc("_score"), self.id_col).limit(k)


def bm25(table: DataFrame, text_col: str, query: str, id_col: str) -> DataFrame:
    """id_col and _score of all rows that hold a query term. Statistics are the whole table's, however it is partitioned.

    Rows are read once for N and the mean length and once for the terms; only rows with a term, already reduced to
    one count a term, go through a shuffle.
    """
    terms = sorted(set(_terms(table.sparkSession, query)))
    if not terms:
        raise ValueError("query must have a term")
    sized = table.select(id_col, tokens(text_col).alias("_tokens")).select(id_col, F.size("_tokens").alias("length"), *[_count("_tokens", t).alias(f"tf{i}") for i, t in enumerate(terms)])
    stats = sized.agg(F.count("*").alias("n"), F.avg("length").alias("mean"), *[F.sum((F.col(f"tf{i}") > 0).cast("long")).alias(f"df{i}") for i in range(len(terms))])
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.log(1 + (F.col("n") - F.col(f"df{i}") + F.lit(0.5)) / (F.col(f"df{i}") + F.lit(0.5)))
        tf = F.col(f"tf{i}").cast("double")
        score = score + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("mean")))).otherwise(0.0)
    held = sized.filter(F.greatest(F.lit(0), *[F.col(f"tf{i}") for i in range(len(terms))]) > 0)
    return held.crossJoin(F.broadcast(stats)).select(id_col, score.alias("_score"))  # stats is one row


def _count(words: str, term: str) -> Column:
    return F.size(F.filter(words, lambda x: x == F.lit(term)))


def _terms(spark, query: str) -> list[str]:
    return spark.range(1).select(tokens(F.lit(query)).alias("t")).first()["t"]


def full_text_search(table: DataFrame, text_col: str, query: str, k: int = 10, id_col: str = "doc_id", filter: Column | str | None = None, prefilter: bool = False) -> DataFrame:
    """The k rows of the highest BM25 _score, ties by id_col. A filter applies before the k are taken (prefilter) or after;
    statistics are the whole table's in either case."""
    _positive(k=k)
    scored = bm25(table, text_col, query, id_col)
    if filter is not None and prefilter:
        scored = scored.join(table.filter(filter).select(id_col), id_col, "left_semi")
    best = scored.orderBy(F.desc("_score"), id_col).limit(k)
    found = table.join(F.broadcast(best), id_col)  # k rows
    found = found if filter is None or prefilter else found.filter(filter)
    return found.orderBy(F.desc("_score"), id_col)


def _normal(value: str, low: str, high: str) -> Column:
    """Into 0 to 1 by the range of the finite values; 0.5 where they are all alike; 0 for what is not finite."""
    finite = _finite(F.col(value))
    spread = F.col(high) - F.col(low)
    scaled = F.when(spread < 1e-12, F.lit(0.5)).otherwise((F.col(value) - F.col(low)) / spread)
    return F.when(finite, F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled))).otherwise(0.0)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def hybrid_search(table: DataFrame, vector_col: str, query_vector: Sequence[float], text_col: str, query_text: str, k: int = 10, id_col: str = "doc_id", alpha: float = 0.5, oversample_factor: int = 4, metric: str = "l2", filter: Column | str | None = None, prefilter: bool = False) -> DataFrame:
    """The k rows of the highest _hybrid_score = alpha (1 - distance) + (1 - alpha) score, both scaled over their candidates.

    Each side takes max(k * oversample_factor, k) candidates; a row that only one side has counts 0 for the other and has
    null there. alpha is held to 0 to 1.
    """
    _positive(k=k, oversample_factor=oversample_factor)
    alpha = min(1.0, max(0.0, alpha))
    size = max(k * oversample_factor, k)
    near = vector_search(table, vector_col, query_vector, size, id_col, metric, filter if prefilter else None, prefilter).select(id_col, "_distance")
    rows = bm25(table, text_col, query_text, id_col)
    if filter is not None and prefilter:
        rows = rows.join(table.filter(filter).select(id_col), id_col, "left_semi")
    said = rows.orderBy(F.desc("_score"), id_col).limit(size)
    both = near.join(said, id_col, "full_outer")
    ranges = both.agg(*[f(F.when(_finite(F.col(c)), F.col(c))).alias(f"{c}_{n}") for c in ("_distance", "_score") for n, f in (("low", F.min), ("high", F.max))])
    scaled = both.crossJoin(F.broadcast(ranges))  # one row
    near_part = F.when(F.col("_distance").isNull(), 0.0).otherwise(alpha * (1 - _normal("_distance", "_distance_low", "_distance_high")))
    said_part = F.when(F.col("_score").isNull(), 0.0).otherwise((1 - alpha) * _normal("_score", "_score_low", "_score_high"))
    best = scaled.select(id_col, "_distance", "_score", (near_part + said_part).alias("_hybrid_score")).orderBy(F.desc("_hybrid_score"), id_col).limit(k)
    found = table.join(F.broadcast(best), id_col)  # k rows
    found = found if filter is None or prefilter else found.filter(filter)
    return found.orderBy(F.desc("_hybrid_score"), id_col)


def reciprocal_rank_fusion(first: DataFrame, second: DataFrame, id_col: str, k: int = 10, constant: int = 60) -> DataFrame:
    """Fuses two ranked lists (id_col, rank from 1) by the sum of 1 / (constant + rank)."""
    both = first.select(id_col, F.col("rank").alias("_a")).join(second.select(id_col, F.col("rank").alias("_b")), id_col, "full_outer")
    part = lambda c: F.coalesce(1.0 / (constant + F.col(c)), F.lit(0.0))
    return both.select(id_col, (part("_a") + part("_b")).alias("_hybrid_score")).orderBy(F.desc("_hybrid_score"), id_col).limit(k)
