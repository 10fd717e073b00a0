"""Streams into versioned tables, and streaming aggregations over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.snapshots import Snapshots


def append_stream(stream: DataFrame, table: Snapshots, checkpoint: str, name: str, **trigger) -> StreamingQuery:
    """Each micro-batch becomes one version. A batch that was committed before a restart is not written again: its number is
    kept with the table under the stream's name, in the same commit as its files."""

    def write(batch: DataFrame, number: int) -> None:
        key = f"stream.{name}"
        if table.versions():
            manifest = table.manifest()
            if int(manifest["properties"].get(key, -1)) >= number:
                return
            new = table._write(batch, manifest["next_id"], table.schema(manifest))
            table._commit(manifest | {"files": manifest["files"] + new, "next_id": manifest["next_id"] + len(new), "properties": manifest["properties"] | {key: str(number)}}, manifest["version"] + 1)
        else:
            table.write(batch, properties={key: str(number)})

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(events: DataFrame, time_col: str, key_col: str, value_col: str, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Rows and the sum of values for each window of event time and key; rows later than `late` behind the newest are left out."""
    return (
        events.withColumn(time_col, F.col(time_col).cast("timestamp"))  # watermarks need an instant
        .withWatermark(time_col, late)
        .groupBy(F.window(time_col, window).alias("w"), key_col)
        .agg(F.count("*").alias("n"), F.sum(value_col).alias("total"))
        .select(F.col("w.start").alias("start"), key_col, "n", "total")
    )
