"""Secondary indexes: side tables that lead from a value to the rows that hold it. Files written after an index was built are
searched without it, so an index never hides rows. Named indexes are listed in the table's properties."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..sources.snapshots import ROW_ID, Snapshots


class _Index:
    """entries: key, _rowid, in order of key. files: the numbers of the files it covers. column: as the files name it, so that
    an index outlives a renamed column."""

    options: dict[str, str] = {}

    def __init__(self, table: Snapshots, column: str, path: str, files: set[int]):
        self.table, self.stored, self.path, self.files = table, _stored(table, column), path, files

    @property
    def column(self) -> str:
        return next(f.name for f in self.table.schema(self.table.manifest()) if f.metadata.get("stored", f.name) == self.stored)

    @staticmethod
    def keys(rows: DataFrame, column: str) -> DataFrame:
        """key and _rowid of the rows."""

    @classmethod
    def build(cls, table: Snapshots, column: str):
        path = f"{table.path}/indexes/{cls.__name__}-{uuid.uuid4().hex}"
        index = cls(table, column, path, set())
        index.extend()
        return index

    def extend(self) -> int:
        """Index the files that are not covered yet; how many those were."""
        manifest = self.table.manifest()
        new = [f for f in manifest["files"] if f["id"] not in self.files]
        if new or not self.files:
            entries = self.keys(self.table._rows(manifest, new, True), self.column)
            (entries.repartitionByRange("key", ROW_ID) if new else entries).sortWithinPartitions("key", ROW_ID).write.options(**self.options).mode("append").parquet(self.path)
        self.files |= {f["id"] for f in new}
        return len(new)

    def entries(self) -> DataFrame:
        return self.table.spark.read.parquet(self.path)

    def _fetch(self, hits: DataFrame, matches) -> DataFrame:
        """Rows by the ids in hits, from files that hold one, and by `matches` from the files that are not covered."""
        manifest = self.table.manifest()
        ids = {f["id"] for f in manifest["files"]}
        found = {r["f"] for r in hits.select(F.shiftright(ROW_ID, 32).alias("f")).distinct().collect()} & ids
        old = self.table._rows(manifest, [f for f in manifest["files"] if f["id"] in found], True).join(hits.select(ROW_ID).distinct(), ROW_ID, "left_semi")
        new = [f for f in manifest["files"] if f["id"] not in self.files]
        return old.unionByName(self.table._rows(manifest, new, True).filter(matches)) if new else old


class ValueIndex(_Index):
    """Sorted values: equality and ranges read the row groups whose range fits."""

    @staticmethod
    def keys(rows: DataFrame, column: str) -> DataFrame:
        return rows.select(F.col(column).alias("key"), ROW_ID).filter("key is not null")

    def lookup(self, values: list[Any]) -> DataFrame:
        return self._fetch(self.entries().filter(F.col("key").isin(values)), F.col(self.column).isin(values))

    def between(self, low: Any, high: Any) -> DataFrame:
        return self._fetch(self.entries().filter(F.col("key").between(low, high)), F.col(self.column).between(low, high))


class BloomIndex(ValueIndex):
    """ValueIndex with a Parquet Bloom filter of the values, for equality on values in no order."""

    options = {"parquet.bloom.filter.enabled#key": "true"}


class TokenIndex(_Index):
    """Words of a text column."""

    @staticmethod
    def keys(rows: DataFrame, column: str) -> DataFrame:
        return rows.select(ROW_ID, F.explode(F.array_distinct(tokens(column))).alias("key")).select("key", ROW_ID)

    def containing(self, word: str) -> DataFrame:
        word = word.lower()
        return self._fetch(self.entries().filter(F.col("key") == word), F.array_contains(tokens(self.column), word))


class NgramIndex(_Index):
    """Three-character pieces of a text column: a substring's pieces narrow the rows, which are then tested."""

    @staticmethod
    def _pieces(text):
        text = F.lower(text)
        last = F.greatest(F.length(text) - 2, F.lit(0))
        return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))

    @classmethod
    def keys(cls, rows: DataFrame, column: str) -> DataFrame:
        return rows.select(ROW_ID, F.explode(cls._pieces(F.col(column))).alias("key")).select("key", ROW_ID)

    def containing(self, part: str) -> DataFrame:
        matches = F.col(self.column).contains(part)
        pieces = sorted({part.lower()[i : i + 3] for i in range(len(part) - 2)})
        if not pieces:
            return self.table.read(row_ids=True).filter(matches)
        hits = self.entries().filter(F.col("key").isin(pieces)).groupBy(ROW_ID).agg(F.count("*").alias("n")).filter(F.col("n") == len(pieces))
        return self._fetch(hits, matches).filter(matches)


class LabelIndex(_Index):
    """Elements of an array column."""

    @staticmethod
    def keys(rows: DataFrame, column: str) -> DataFrame:
        return rows.select(ROW_ID, F.explode(F.array_distinct(column)).alias("key")).select("key", ROW_ID).filter("key is not null")

    def has_any(self, labels: list[Any]) -> DataFrame:
        return self._fetch(self.entries().filter(F.col("key").isin(labels)), F.arrays_overlap(F.col(self.column), F.array(*[F.lit(x) for x in labels])))


KINDS = {"btree": ValueIndex, "bloomfilter": BloomIndex, "inverted": TokenIndex, "ngram": NgramIndex, "label_list": LabelIndex}
_NAMED = "index."


def _stored(table: Snapshots, column: str) -> str:
    found = [f.metadata.get("stored", f.name) for f in table.schema(table.manifest()) if f.name == column]
    if not found:
        raise ValueError(f"no such column: {column}")
    return found[0]


def _entry(table: Snapshots, name: str) -> dict[str, Any]:
    text = table.manifest()["properties"].get(_NAMED + name)
    if text is None:
        raise ValueError(f"no index {name}")
    return json.loads(text)


def _keep(name: str, kind: str, index: _Index) -> None:
    index.table.set_property(_NAMED + name, json.dumps({"kind": kind, "stored": index.stored, "path": index.path, "files": sorted(index.files)}))


def create_index(table: Snapshots, name: str, column: str, kind: str = "btree", replace: bool = False) -> _Index:
    """Build an index and list it under its name, which must be new unless replace is true."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    if _NAMED + name in table.manifest()["properties"] and not replace:
        raise ValueError(f"an index {name} exists")
    index = KINDS[kind].build(table, column)
    _keep(name, kind, index)
    return index


def open_index(table: Snapshots, name: str) -> _Index:
    entry = _entry(table, name)
    names = {f.metadata.get("stored", f.name): f.name for f in table.schema(table.manifest())}
    if entry["stored"] not in names:
        raise ValueError(f"the column of index {name} is dropped")
    return KINDS[entry["kind"]](table, names[entry["stored"]], entry["path"], set(entry["files"]))


def show_indexes(table: Snapshots) -> DataFrame:
    """name, kind, column (null if it is dropped), indexed_rows, unindexed_rows of each named index, by name."""
    manifest, rows = table.manifest(), []
    names = {f.metadata.get("stored", f.name): f.name for f in table.schema(manifest)}
    for key, text in sorted(manifest["properties"].items()):
        if key.startswith(_NAMED):
            entry = json.loads(text)
            covered = sum(f["rows"] for f in manifest["files"] if f["id"] in entry["files"])
            rows.append((key[len(_NAMED) :], entry["kind"], names.get(entry["stored"]), covered, sum(f["rows"] for f in manifest["files"]) - covered))
    return table.spark.createDataFrame(rows, "name string, kind string, column string, indexed_rows long, unindexed_rows long")


def drop_index(table: Snapshots, name: str) -> int:
    """Take an index off the list; its files stay for readers of older versions."""
    _entry(table, name)
    return table.set_property(_NAMED + name, None)


def optimize_index(table: Snapshots, name: str, rebuild: bool = False) -> int:
    """Index the files written since, beside what is there, or everything anew; how many files were indexed."""
    entry, index = _entry(table, name), open_index(table, name)
    if rebuild:
        index = KINDS[entry["kind"]].build(table, index.column)
        done = len(index.files)
    else:
        done = index.extend()
    if done:
        _keep(name, entry["kind"], index)
    return done


def zone_map(table: Snapshots, column: str) -> DataFrame:
    """The least and the greatest value and the nulls of a column in each file."""
    rows = table.read(row_ids=True)
    return rows.groupBy(F.shiftright(ROW_ID, 32).alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"), F.sum(F.col(column).isNull().cast("long")).alias("nulls"), F.count("*").alias("rows"))
