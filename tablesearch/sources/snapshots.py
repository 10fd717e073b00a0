"""A table with versions: Parquet files that are never changed, and for each version a list of the files it has.

A version is one small JSON file. It is written beside its place and renamed there, never over another, so a crash leaves no
half-written version and of two writers of the same version one fails. Both need a file system that renames at once and
refuses to rename over a file (HDFS does; on object stores without that, one writer at a time is safe). Changes rewrite the
files that hold affected rows and no others. All data goes through Spark readers and writers; only file names, counts and
settings are on the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dml

ROW_ID = "_rowid"
CLEANUP_EVERY, CLEANUP_RETAIN, CLEANUP_OLDER = "cleanup.interval", "cleanup.retain_versions", "cleanup.older_than"


class Conflict(RuntimeError):
    """Another writer made this version first."""


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # files of the driver

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _list(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._list(f"{self.path}/versions") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no table at {self.path}")
        version = known[-1] if version is None else version
        if version not in known:
            raise ValueError(f"no version {version} of {self.path}")
        text = self.spark.read.text(f"{self.path}/versions/{version:020d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, manifest: dict[str, Any], version: int) -> int:
        manifest = manifest | {"version": version, "timestamp": time.time()}
        sc = self.spark.sparkContext
        fs, beside = self._fs(f"{self.path}/versions/.{uuid.uuid4().hex}.tmp")
        where = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{version:020d}.json")
        out = fs.create(beside, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        no_options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), fs.makeQualified(where), no_options)
        except Exception as e:
            fs.delete(beside, False)
            if fs.exists(where):
                raise Conflict(f"version {version} of {self.path} exists already") from e
            raise
        settings = manifest.get("properties", {})
        every = int(settings.get(CLEANUP_EVERY, 0))
        if every and version % every == 0:
            self.vacuum(int(settings[CLEANUP_RETAIN]), float(settings.get(CLEANUP_OLDER, 0)))
        return version

    def transaction(self) -> Transaction:
        """with table.transaction() as t: changes of t are one version, made at the end if nobody else wrote meanwhile; an
        exception makes none."""
        return Transaction(self)

    # reading

    def schema(self, manifest: dict[str, Any]) -> T.StructType:
        return T.StructType.fromJson(manifest["schema"])

    def read(self, version: int | None = None, row_ids: bool = False) -> DataFrame:
        """The rows of a version (the newest), which stays what it is while others write. row_ids adds _rowid."""
        return self._rows(self.manifest(version), None, row_ids)

    def _rows(self, manifest: dict[str, Any], files: list[dict] | None, row_ids: bool = False) -> DataFrame:
        files = manifest["files"] if files is None else files
        schema = self.schema(manifest)
        if not files:
            return self.spark.createDataFrame([], T.StructType([*schema, *([T.StructField(ROW_ID, T.LongType())] if row_ids else [])]))
        stored = T.StructType([T.StructField(f.metadata.get("stored", f.name), f.dataType, True) for f in schema])
        rows = self.spark.read.schema(stored).parquet(*[f"{self.path}/data/{f['name']}" for f in files])
        out = [F.col(f.metadata.get("stored", f.name)).alias(f.name) for f in schema]
        if not row_ids:
            return rows.select(*out)
        # A row's id: its file's number and its place in the file. The map of names is a row a file.
        names = self.spark.createDataFrame([(f["name"].rsplit("/", 1)[-1], f["id"]) for f in files], "_name string, _file long")
        named = rows.select(*out, F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_place"))
        return named.join(names, "_name").withColumn(ROW_ID, F.shiftleft("_file", 32).bitwiseOR(F.col("_place"))).drop("_name", "_place", "_file")

    def take(self, row_ids: list[int], version: int | None = None) -> DataFrame:
        """Rows by id; only the files of these ids are read, unknown ids are ignored, repeated ones give one row."""
        manifest = self.manifest(version)
        wanted = {i >> 32 for i in row_ids}
        return self._rows(manifest, [f for f in manifest["files"] if f["id"] in wanted], True).filter(F.col(ROW_ID).isin([int(i) for i in set(row_ids)]) if row_ids else F.lit(False))

    def count(self, version: int | None = None) -> int:
        """From the row counts of the files; no data is read."""
        return sum(f["rows"] for f in self.manifest(version)["files"])

    def deferred(self, light: list[str], heavy: list[str], condition: Column | str, version: int | None = None) -> DataFrame:
        """The heavy columns of the rows whose light columns meet a condition: the files that hold any are found first, and
        the heavy columns of no other are read."""
        manifest = self.manifest(version)
        ids = self._rows(manifest, None, True).select(*light, ROW_ID).filter(condition).select(F.shiftright(ROW_ID, 32).alias("f")).distinct()
        hit = {r["f"] for r in ids.collect()}  # file numbers
        return self._rows(manifest, [f for f in manifest["files"] if f["id"] in hit]).select(*light, *heavy).filter(condition)

    # writing

    def _write(self, rows: DataFrame, next_id: int, schema: T.StructType, max_rows_per_file: int = 1 << 20) -> list[dict]:
        for f in schema:
            if not f.nullable:
                rows = rows.withColumn(f.name, F.when(F.col(f"`{f.name}`").isNotNull(), F.col(f"`{f.name}`")).otherwise(F.raise_error(F.lit(f"column {f.name} is not null")).cast(f.dataType)))
        folder = uuid.uuid4().hex
        where = f"{self.path}/data/{folder}"
        stored = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.metadata.get("stored", f.name)) for f in schema])
        stored.write.option("maxRecordsPerFile", max_rows_per_file).parquet(where)
        names = [n for n in self._list(where) if n.endswith(".parquet")]
        if not names:
            return []
        counts = {r["n"]: r["c"] for r in self.spark.read.parquet(where).groupBy(F.col("_metadata.file_name").alias("n")).agg(F.count("*").alias("c")).collect()}
        return [{"id": next_id + i, "name": f"{folder}/{n}", "rows": counts[n]} for i, n in enumerate(x for x in names if counts.get(x))]

    def write(self, rows: DataFrame, mode: str = "create", max_rows_per_file: int = 1 << 20, if_not_exists: bool = False, properties: dict[str, str] | None = None) -> int:
        """mode: create (an error if the table exists, or nothing with if_not_exists), append or overwrite. properties are set in
        the same version."""
        if max_rows_per_file <= 0:
            raise ValueError("max_rows_per_file must be positive")
        known = self.versions()
        if mode == "create" and known:
            if if_not_exists:
                return known[-1]
            raise FileExistsError(f"a table is at {self.path}")
        if mode not in ("create", "append", "overwrite"):
            raise ValueError("mode must be create, append or overwrite")
        old = self.manifest() if known else {"files": [], "next_id": 0, "properties": {}, "comment": None}
        schema = self.schema(old) if mode == "append" and known else T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema])
        if mode == "append" and {f.name for f in rows.schema} != {f.name for f in schema}:
            raise ValueError(f"columns must be {', '.join(schema.names)}")
        self._check_vectors(rows)
        new = self._write(rows, old["next_id"], schema, max_rows_per_file)
        files = (old["files"] if mode == "append" else []) + new
        return self._commit(old | {"schema": json.loads(schema.json()), "files": files, "next_id": old["next_id"] + len(new), "properties": old["properties"] | (properties or {})}, (known[-1] if known else 0) + 1)

    def _check_vectors(self, rows: DataFrame) -> None:
        """Lists of floats are vectors: all of a column have one length, which is not zero."""
        vectors = [f.name for f in rows.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.FloatType, T.DoubleType))]
        if not vectors:
            return
        sizes = rows.agg(*[f(F.when(F.col(c).isNotNull(), F.size(c))).alias(f"{n}_{i}") for i, c in enumerate(vectors) for n, f in (("low", F.min), ("high", F.max))]).first()
        for i, c in enumerate(vectors):
            if sizes[f"low_{i}"] is not None and (sizes[f"low_{i}"] != sizes[f"high_{i}"] or sizes[f"low_{i}"] == 0):
                raise ValueError(f"vector dim mismatch in column {c}")

    def _affected(self, manifest: dict[str, Any], condition: Column | str | None) -> list[dict]:
        if condition is None:
            return manifest["files"]
        hit = F.expr(condition) if isinstance(condition, str) else condition
        found = self._rows(manifest, None, True).filter(hit).select(F.shiftright(ROW_ID, 32).alias("f")).distinct().collect()
        ids = {r["f"] for r in found}
        return [f for f in manifest["files"] if f["id"] in ids]

    def _replace(self, manifest: dict[str, Any], old: list[dict], rows: DataFrame | None) -> int:
        gone = {f["id"] for f in old}
        new = self._write(rows, manifest["next_id"], self.schema(manifest)) if rows is not None else []
        return self._commit(manifest | {"files": [f for f in manifest["files"] if f["id"] not in gone] + new, "next_id": manifest["next_id"] + len(new)}, manifest["version"] + 1)

    def insert(self, rows: DataFrame) -> int:
        return self.write(rows, "append")

    def update(self, assignments: dict[str, Column | str], condition: Column | str | None = None) -> int:
        manifest = self.manifest()
        files = self._affected(manifest, condition)
        return self._replace(manifest, files, dml.update(self._rows(manifest, files), assignments, condition)) if files else manifest["version"]

    def delete(self, condition: Column | str | None = None) -> int:
        """No matching row makes no version; no condition drops all files without reading them."""
        manifest = self.manifest()
        files = self._affected(manifest, condition)
        if not files:
            return manifest["version"]
        return self._replace(manifest, files, None if condition is None else dml.delete(self._rows(manifest, files), condition))

    def truncate(self) -> int:
        """Drop all rows without reading them; how many there were."""
        before = self.count()
        self.delete()
        return before

    def merge(self, source: DataFrame, on: str, clauses: list[dml.When], source_order: list[str]) -> int:
        """on and the clauses read t.<column> and s.<column>. Files with no changed row stay as they are."""
        return self._merge(source, on, clauses, source_order)[0]

    def merge_returning(self, source: DataFrame, on: str, clauses: list[dml.When], source_order: list[str]) -> tuple[int, DataFrame, dict[str, int]]:
        """merge, with the rows that it updated, inserted or deleted (deleted ones as they were) with merge_action, and their
        number by action. The rows are read from the version before and stay readable until that is cleaned up."""
        version, rows = self._merge(source, on, clauses, source_order)
        changed = rows.filter("merge_action in ('UPDATE', 'INSERT', 'DELETE')").drop(ROW_ID)
        return version, changed, {r["merge_action"]: r["n"] for r in changed.groupBy("merge_action").agg(F.count("*").alias("n")).collect()}

    def _merge(self, source: DataFrame, on: str, clauses: list[dml.When], source_order: list[str]) -> tuple[int, DataFrame]:
        manifest = self.manifest()
        files = manifest["files"]
        if all(c.kind != dml.NOT_MATCHED_BY_SOURCE for c in clauses):  # files without a match cannot change
            met = self._rows(manifest, None, True).alias("t").join(source.alias("s"), F.expr(on), "left_semi").select(F.shiftright(ROW_ID, 32).alias("f")).distinct()
            hit = {r["f"] for r in met.collect()}
            files = [f for f in files if f["id"] in hit]
        rows = dml.merge_rows(self._rows(manifest, files, True), source, on, clauses, ROW_ID, source_order)
        touched = {r["f"] for r in rows.filter(f"merge_action in ('UPDATE', 'DELETE') and {ROW_ID} is not null").select(F.shiftright(ROW_ID, 32).alias("f")).distinct().collect()}
        kept = rows.filter("merge_action is null or merge_action <> 'DELETE'").filter(F.col(ROW_ID).isNull() | F.shiftright(ROW_ID, 32).isin(sorted(touched)))
        return self._replace(manifest, [f for f in files if f["id"] in touched], kept.drop(ROW_ID, "merge_action")), rows

    # upkeep

    def compact(self, target_rows: int = 1 << 20) -> int:
        """Rewrite files of fewer than target_rows rows into larger ones; others stay."""
        manifest = self.manifest()
        small = [f for f in manifest["files"] if f["rows"] < target_rows]
        if len(small) < 2:
            return manifest["version"]
        total = sum(f["rows"] for f in small)
        return self._replace(manifest, small, self._rows(manifest, small).repartition(max(1, -(-total // target_rows))))

    def vacuum(self, retain_versions: int = 1, older_than: float = 0) -> int:
        """Delete versions before the newest retain_versions that are older than older_than seconds, and the files that only they
        have; how many files went."""
        if retain_versions <= 0 or older_than < 0:
            raise ValueError("retain_versions must be positive, older_than not negative")
        known, last = self.versions(), time.time() - older_than
        manifests = {v: self.manifest(v) for v in known}
        old = [v for v in known[:-retain_versions] if manifests[v]["timestamp"] <= last]
        keep = {f["name"] for v in known if v not in old for f in manifests[v]["files"]}
        gone = 0
        for v in old:
            for f in manifests[v]["files"]:
                if f["name"] not in keep:
                    fs, where = self._fs(f"{self.path}/data/{f['name']}")
                    gone += bool(fs.delete(where, False))
            fs, where = self._fs(f"{self.path}/versions/{v:020d}.json")
            fs.delete(where, False)
        return gone

    def set_auto_cleanup(self, interval: int | None, retain_versions: int = 1, older_than: float = 0) -> int:
        """Vacuum at every interval-th version; None turns it off."""
        if interval is not None and (interval <= 0 or retain_versions <= 0 or older_than < 0):
            raise ValueError("interval and retain_versions must be positive, older_than not negative")
        on = interval is not None
        self.set_properties({CLEANUP_RETAIN: str(retain_versions) if on else None, CLEANUP_OLDER: str(older_than) if on and older_than else None})
        return self.set_property(CLEANUP_EVERY, str(interval) if on else None)

    def maintenance(self) -> DataFrame:
        """Settings of upkeep as rows of key and value."""
        p = self.manifest()["properties"]
        rows = [("enabled", str(CLEANUP_EVERY in p).lower()), ("interval", p.get(CLEANUP_EVERY)), ("retain_versions", p.get(CLEANUP_RETAIN))]
        rows += [("older_than", p[CLEANUP_OLDER])] if CLEANUP_OLDER in p else []
        return self.spark.createDataFrame(rows, "key string, value string")

    # schema

    def _evolve(self, fields: list[T.StructField], **more: Any) -> int:
        manifest = self.manifest()
        return self._commit(manifest | {"schema": json.loads(T.StructType(fields).json())} | more, manifest["version"] + 1)

    def _fields(self, manifest: dict[str, Any], *names: str) -> list[T.StructField]:
        schema = self.schema(manifest)
        if missing := [n for n in names if n not in schema.names]:
            raise ValueError(f"no such column: {', '.join(missing)}")
        return list(schema)

    def add_column(self, name: str, kind: str, default: str | None = None) -> int:
        """Null in all rows, without touching data; with a default (over the other columns) the files are rewritten."""
        manifest = self.manifest()
        fields = self._fields(manifest)
        if name in [f.name for f in fields]:
            raise ValueError(f"column {name} exists")
        new = T.StructField(name, T.DataType.fromDDL(kind), True, {"stored": f"{name}_{uuid.uuid4().hex[:8]}"})
        if default is None:
            return self._evolve([*fields, new])
        schema = T.StructType([*fields, new])
        rows = self._rows(manifest, None).withColumn(name, F.expr(default))
        files = self._write(rows, manifest["next_id"], schema)
        return self._evolve(list(schema), files=files, next_id=manifest["next_id"] + len(files))

    def drop_column(self, name: str) -> int:
        return self._evolve([f for f in self._fields(self.manifest(), name) if f.name != name])

    def rename_column(self, old: str, new: str) -> int:
        """The files keep the name they were written with; only the table's name changes."""
        fields = self._fields(self.manifest(), old)
        if new in [f.name for f in fields]:
            raise ValueError(f"column {new} exists")
        return self._evolve([T.StructField(new, f.dataType, f.nullable, f.metadata | {"stored": f.metadata.get("stored", old)}) if f.name == old else f for f in fields])

    def alter_type(self, name: str, kind: str) -> int:
        manifest = self.manifest()
        fields = [T.StructField(f.name, T.DataType.fromDDL(kind), f.nullable, f.metadata) if f.name == name else f for f in self._fields(manifest, name)]
        rows = self._rows(manifest, None).withColumn(name, F.col(name).cast(kind))
        files = self._write(rows, manifest["next_id"], T.StructType(fields))
        return self._evolve(fields, files=files, next_id=manifest["next_id"] + len(files))

    def set_not_null(self, name: str, not_null: bool = True) -> int:
        manifest = self.manifest()
        fields = self._fields(manifest, name)
        if not_null and self._rows(manifest, None).filter(F.col(name).isNull()).limit(1).count():
            raise ValueError(f"column {name} holds nulls")
        return self._evolve([T.StructField(f.name, f.dataType, not not_null, f.metadata) if f.name == name else f for f in fields])

    def comment(self, text: str | None, column: str | None = None) -> int:
        manifest = self.manifest()
        fields = self._fields(manifest, *([column] if column else []))
        if column is None:
            return self._evolve(fields, comment=text)
        return self._evolve([T.StructField(f.name, f.dataType, f.nullable, {k: v for k, v in (f.metadata | {"comment": text}).items() if v is not None}) if f.name == column else f for f in fields])

    def set_property(self, key: str, value: str | None) -> int:
        return self.set_properties({key: value})

    def set_properties(self, values: dict[str, str | None]) -> int:
        """Set what has a value and remove what has None, in one version."""
        manifest = self.manifest()
        properties = {k: v for k, v in (manifest["properties"] | values).items() if v is not None}
        return self._evolve(self._fields(manifest), properties=properties)


class Transaction(Snapshots):
    """A table whose commits are held back: inside, later changes see earlier ones; outside, nothing is seen until the end."""

    def __init__(self, table: Snapshots):
        super().__init__(table.spark, table.path)
        self._base = super().manifest()
        self._now = self._base

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        return self._now if version is None or version == self._now["version"] else super().manifest(version)

    def _commit(self, manifest: dict[str, Any], version: int) -> int:
        if manifest["schema"] != self._base["schema"]:
            raise ValueError("a transaction cannot change the schema")
        self._now = manifest | {"version": self._base["version"]}
        return self._base["version"]

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None and self._now is not self._base:
            Snapshots(self.spark, self.path)._commit(self._now, self._base["version"] + 1)


class Namespace:
    """A folder of tables, by name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> Snapshots:
        if not name or "/" in name or name.startswith("."):
            raise ValueError("not a table name")
        return Snapshots(self.spark, f"{self.path}/{name}")

    def list_tables(self) -> list[str]:
        own = Snapshots(self.spark, self.path)
        return [n for n in own._list(self.path) if Snapshots(self.spark, f"{self.path}/{n}").versions()]

    def drop(self, name: str) -> bool:
        fs, where = self.table(name)._fs(f"{self.path}/{name}")
        return bool(fs.delete(where, True))
