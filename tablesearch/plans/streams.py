"""Structured Streaming queries, run to the end of what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..streaming.ingest import append_stream, windowed_counts
from ..sources.snapshots import Snapshots
from .registry import Tables, new_folder, query


def _events(t: Tables) -> DataFrame:
    """The events table as a stream of its files; the file is copied into a folder of its own, since streams read folders."""
    folder = new_folder(t)
    t.events.write.parquet(folder)
    return t.spark.readStream.schema(t.events.schema).parquet(folder)


@query("SELECT * FROM events")
def stream_append(t: Tables) -> DataFrame:
    table = Snapshots(t.spark, new_folder(t))
    append_stream(_events(t), table, new_folder(t), "events").awaitTermination()
    return table.read()


@query("SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_windows(t: Tables) -> DataFrame:
    out, name = new_folder(t), f"w{uuid.uuid4().hex}"
    counts = windowed_counts(_events(t), "ts", "event_type", "value")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{number}")

    run = counts.writeStream.queryName(name).outputMode("complete").foreachBatch(keep).option("checkpointLocation", new_folder(t)).trigger(availableNow=True).start()
    run.awaitTermination()
    last = max(p["batchId"] for p in run.recentProgress)
    return t.spark.read.parquet(f"{out}/{last}").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
