"""Large values by reference: a locator names table, version, column and row; fetching reads that row's file only."""

from __future__ import annotations

from urllib.parse import parse_qs, quote, urlsplit

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .snapshots import Snapshots

SCHEME = "table-blob"


def blob_uri(table: Snapshots, column: str, row_id: Column, version: int | None = None) -> Column:
    """The locator of a row's value in a version that is fixed now; null for a null row id."""
    manifest = table.manifest(version)
    if column not in table.schema(manifest).names:
        raise ValueError(f"no such column: {column}")
    head = f"{SCHEME}://v1/?dataset={quote(table.path, safe='')}&version={manifest['version']}&column={quote(column, safe='')}&rowid="
    return F.concat(F.lit(head), row_id.cast("string"))


def read_blob(spark: SparkSession, uri: str, offset: int = 0, length: int | None = None) -> bytes | None:
    """The bytes a locator names, or length of them from offset on; text is UTF-8."""
    parts = urlsplit(uri)
    if parts.scheme != SCHEME or parts.netloc != "v1":
        raise ValueError("not a blob locator")
    q = {k: v[0] for k, v in parse_qs(parts.query).items()}
    table = Snapshots(spark, q["dataset"])
    value = F.col(q["column"]).cast("binary")
    value = F.substring(value, offset + 1, length) if length is not None else F.expr(f"substring(cast(`{q['column']}` as binary), {offset + 1})")
    row = table.take([int(q["rowid"])], int(q["version"])).select(value).first()
    if row is None:
        raise KeyError(f"no row {q['rowid']}")
    return None if row[0] is None else bytes(row[0])
