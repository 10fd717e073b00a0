"""Every registered query of the base library against its SQL in DuckDB."""

import datetime
import math

import duckdb
import pytest

from tablesearch import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as from '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(float(v)) if isinstance(v, float) or hasattr(v, "as_tuple") else repr(v)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(spark, sf, oracle, name):
    df = plans.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = oracle.execute(plans.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_ivf_recall(spark, sf):
    exact = {(r["query_id"], r["vec_id"]) for r in plans.QUERIES["vector_search_batch"](spark, sf).collect()}
    found = {(r["query_id"], r["vec_id"]) for r in plans.QUERIES["vector_search_ivf"](spark, sf).collect()}
    assert len(exact & found) / len(exact) >= 0.9


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())
