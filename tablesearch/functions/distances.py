"""Distances between vector columns and a query vector, as expressions that stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "dot")


def checked_vector(query: Sequence[float]) -> list[float]:
    """The query as floats; null, empty, non-numeric and non-finite vectors are refused."""
    if query is None or not len(query):
        raise ValueError("query vector must be non-empty")
    values = []
    for x in query:
        if x is None or isinstance(x, (str, bytes, bool)):
            raise ValueError("query vector must have numbers only")
        values.append(float(x))
        if not math.isfinite(values[-1]) or abs(values[-1]) > 3.4028234663852886e38:
            raise ValueError("query vector must have finite 32-bit values only")
    return values


def vector_literal(query: Sequence[float]) -> Column:
    return F.array(*[F.lit(x) for x in checked_vector(query)])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def distance(vector: Column | str, query: Column, metric: str = "l2") -> Column:
    """l2: squared distance; cosine: 1 - cosine; dot: 1 - product. In double precision; null for vectors of another length."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    if metric == "l2":
        value = F.aggregate(F.zip_with(vector, query, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    elif metric == "cosine":
        norm = F.sqrt(_dot(vector, vector)) * F.sqrt(_dot(query, query))
        value = F.when(norm > 0, 1 - _dot(vector, query) / norm)
    elif metric == "dot":
        value = 1 - _dot(vector, query)
    else:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    return F.when(F.size(vector) == F.size(query), value)
