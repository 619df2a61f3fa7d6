"""Series windows that never need one task per station.

A plain `Window.partitionBy("station")` puts a whole series into one task. These helpers cut a
series into chunks of consecutive rows instead, so a station with a third of all rows spreads
over many tasks:

* `over_chunks` repeats the few rows next to a chunk border in the neighbouring chunk (the halo),
  which makes bounded frames (lags, rolling windows, leads) exact inside every chunk;
* `positioned` numbers rows across segments with a small table of segment counts;
* `segment_edges` carries the last and next non-null value over segment borders for fills.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK_ROWS = 4096
KEYS = ("station",)


def hour_index(ts: Column) -> Column:
    """Hours since the epoch of a TIMESTAMP_NTZ, free of the session time zone."""
    return F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)


def hour_start(index: Column) -> Column:
    """Inverse of `hour_index`."""
    day = F.date_from_unix_date(F.floor(index / 24).cast("int"))
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=F.pmod(index, F.lit(24)).cast("int"))


def hour_floor(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def over_chunks(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    pos: str,
    back: int = 0,
    ahead: int = 0,
    keys: Sequence[str] = KEYS,
    size: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach at most `back` rows back and `ahead` rows ahead.

    `pos` numbers the rows of a key without holes. One shuffle on (keys, chunk).
    """
    at = F.col(pos)
    chunk_of = lambda position: F.floor(position / size)
    spread = df.withColumn(
        "_chunk", F.explode(F.sequence(chunk_of(at - ahead), chunk_of(at + back)))
    )
    window = Window.partitionBy(*keys, "_chunk").orderBy(pos)
    added = [column.alias(name) for name, column in columns(window).items()]
    return (
        spread.select("*", *added)
        .filter(F.col("_chunk") == chunk_of(at))
        .drop("_chunk")
    )


def positioned(
    df: DataFrame,
    order: str,
    keys: Sequence[str] = KEYS,
    every: str = "YEAR",
    ties: Sequence[str] = (),
    pos: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based row position within each key, ordered by `order`.

    Rows are numbered inside (key, calendar segment); the offset of a segment comes from the
    per-segment counts, a table smaller than the data by the rows per segment.
    """
    tagged = df.withColumn("_seg", segment_of(F.col(order), every))
    counts = tagged.groupBy(*keys, "_seg").agg(F.count("*").alias("_rows"))
    by_key = Window.partitionBy(*keys)
    running = by_key.orderBy("_seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        *keys,
        "_seg",
        (F.sum("_rows").over(running) - F.col("_rows")).alias("_before"),
        *([F.sum("_rows").over(by_key).alias(total)] if total else []),
    )
    local = F.row_number().over(Window.partitionBy(*keys, "_seg").orderBy(order, *ties))
    return (
        tagged.join(alongside(offsets), [*keys, "_seg"])
        .withColumn(pos, F.col("_before") + local)
        .select(*df.columns, pos, *([total] if total else []))
    )


def alongside(per_segment: DataFrame) -> DataFrame:
    """Mark a per-segment table for a merge join: the rows are shuffled by (keys, segment) for the
    window that follows, so the join rides on that shuffle and neither side is broadcast."""
    return per_segment.hint("merge")


def segment_of(order: Column, every: str) -> Column:
    """Calendar segment number of a date or timestamp column."""
    if every == "YEAR":
        return F.year(order)
    if every == "MONTH":
        return F.year(order) * 12 + F.month(order)
    if every == "DAY":
        return F.unix_date(order.cast("date"))
    raise ValueError(f"unknown segment length: {every}")


def segment_edges(
    df: DataFrame, value: str, order: str, keys: Sequence[str], payload: Column
) -> DataFrame:
    """Per (key, `_seg`): the nearest non-null `payload` before and after the segment.

    `df` already carries `_seg`. Columns added: `_carry` (before) and `_next` (after).
    """
    present = F.when(F.col(value).isNotNull(), F.col(order))
    edges = df.groupBy(*keys, "_seg").agg(
        F.min_by(payload, present).alias("_first"), F.max_by(payload, present).alias("_last")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    )
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_seg").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return edges.select(
        *keys,
        "_seg",
        F.last("_last", ignorenulls=True).over(earlier).alias("_carry"),
        F.last("_first", ignorenulls=True).over(later).alias("_next"),
    )
