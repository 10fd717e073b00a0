"""Samples of an exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Equal ranges of the draws; rows of one range are the most that a task sorts.
RANGES = 1 << 16


def sample_percent(table: DataFrame, percent: float, seed: int = 42) -> DataFrame:
    """floor(rows * percent / 100) rows, uniformly without replacement; a filter belongs after it.

    Each row draws a number. Counts of the draws by range give the range in which the last sampled row lies: rows of the
    ranges before it are taken by a filter, and only its own rows, some RANGES-th of the table, are put in order. The draw of a
    row is the same each time, as long as the table is read in the same way (files, not results of a shuffle).
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must be from 0 to 100")
    drawn = table.select(F.struct("*").alias("row"), F.rand(seed).alias("draw")).withColumn("range", F.floor(F.col("draw") * RANGES).cast("int"))
    counts = sorted((r["range"], r["n"]) for r in drawn.groupBy("range").agg(F.count("*").alias("n")).collect())
    left = int(sum(n for _, n in counts) * percent // 100)
    last = -1
    for last, n in counts:
        if n > left:
            break
        left, last = left - n, last + 1
    rest = drawn.filter(F.col("range") == last).orderBy("draw").limit(left)
    return drawn.filter(F.col("range") < last).union(rest).select("row.*")
