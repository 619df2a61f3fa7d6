"""Sorting, ranking and date ranges (O1-O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_DAYS = 30  # fixed value: default length of a fetch chunk


def sort_series(df: DataFrame, order: str = "ts", keys: Sequence[str] = ("station",)) -> DataFrame:
    """Total order by station and time: a range-partitioned sort, so hot stations spread."""
    return df.orderBy(*keys, order)


def leaderboard(metrics: DataFrame, n: int, metric: str = "mae", ties: Sequence[str] = ("model",)) -> DataFrame:
    """The n best rows by a metric, lowest first; each task keeps n rows before the merge."""
    return metrics.orderBy(metric, *ties).limit(n)


def date_chunks(ranges: DataFrame, days: int = CHUNK_DAYS) -> DataFrame:
    """Cut [start, end] timestamps into contiguous chunks of n days; the last one is capped.

    A chunk ends one second before the next starts.
    """
    step = F.make_dt_interval(days=F.lit(days))
    starts = F.posexplode(F.sequence(F.col("start"), F.col("end"), step)).alias("chunk", "chunk_start")
    second = F.make_dt_interval(secs=F.lit(1))
    return ranges.select("end", starts).select(
        "chunk", "chunk_start", F.least(F.col("chunk_start") + step - second, F.col("end")).alias("chunk_end")
    )
