"""Queries by name, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder of Parquet files, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


_own: dict[str, str] = {}


def new_folder(t: Tables) -> str:
    """A new folder in the cluster's shared one; where spark.checkpoint.dir is unset, in one of a session that is local."""
    shared = t.spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not t.spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        key = t.spark.sparkContext.applicationId
        shared = _own[key] = _own.get(key) or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{shared.rstrip('/')}/table-{uuid.uuid4().hex}"


def query(sql: str | None = None):
    """Registers a function of Tables under its name."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register
