"""Regular grids and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.scalar import clip
from hazeline.operators.validate import remove_outliers
from hazeline.plans.series import (
    KEYS,
    alongside,
    hour_index,
    hour_start,
    over_chunks,
    positioned,
    segment_edges,
    segment_of,
)


def hourly_grid(
    readings: DataFrame,
    keys: Sequence[str] = KEYS,
    fill: bool = False,
    every: str = "MONTH",
    last: str | None = None,
) -> DataFrame:
    """All hours between a station's first and last reading: (keys, hour, ts, pm25, observed).

    `readings` is unique per (keys, hour). Each reading emits its own hour and the empty hours up
    to the next reading, so grid, left join and forward fill cost one shuffle on (keys, segment).
    With `fill`, the empty hours carry the reading's value; otherwise they are null. `last` names
    an extra column with the station's last hour.
    """
    seen = readings.filter(F.col("pm25").isNotNull()).select(
        *keys, "ts", hour_index(F.col("ts")).alias("_at"), "pm25"
    ).withColumn("_seg", segment_of(F.col("ts"), every))
    ends = seen.groupBy(*keys, "_seg").agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_end")
    )
    by_key = Window.partitionBy(*keys)
    following = ends.select(
        *keys,
        "_seg",
        F.lead("_first").over(by_key.orderBy("_seg")).alias("_after"),
        *([F.max("_end").over(by_key).alias(last)] if last else []),
    )
    within = Window.partitionBy(*keys, "_seg").orderBy("_at")
    until = F.coalesce(F.lead("_at").over(within), F.col("_after"), F.col("_at") + 1)
    spans = seen.join(alongside(following), [*keys, "_seg"]).withColumn("_until", until)
    extra = [last] if last else []
    hours = spans.select(
        *keys,
        "_at",
        "pm25",
        *extra,
        F.explode(F.sequence(F.col("_at"), F.col("_until") - 1)).alias("hour"),
    )
    observed = F.col("hour") == F.col("_at")
    return hours.select(
        *keys,
        "hour",
        hour_start(F.col("hour")).alias("ts"),
        (F.col("pm25") if fill else F.when(observed, F.col("pm25"))).alias("pm25"),
        observed.alias("observed"),
        *extra,
    )


def hourly_series(
    readings: DataFrame,
    keys: Sequence[str] = KEYS,
    bounds: tuple[float, float] = (0.0, 500.0),
    last: str | None = None,
) -> DataFrame:
    """Gap-free hourly series: grid, forward fill, clip. The grid starts at a reading, so no
    leading gap can remain."""
    filled = hourly_grid(readings, keys, fill=True, last=last)
    return filled.withColumn("pm25", clip(F.col("pm25"), *bounds))


def join_calendar(daily: DataFrame, start: str, end: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every date of [start, end] for every station, left-joined to the daily values."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    calendar = daily.select(*keys).distinct().withColumn("date", F.explode(days))
    return calendar.join(daily, [*keys, "date"], "left")


def _with_edges(df, value, order, keys, every, payload):
    """The rows with their segment and the nearest non-null payload outside the segment."""
    tagged = df.withColumn("_seg", segment_of(F.col(order), every))
    edges = segment_edges(tagged, value, order, keys, payload)
    return tagged.join(alongside(edges), [*keys, "_seg"])


def fill_series(
    df: DataFrame,
    method: str = "ffill",
    order: str = "date",
    value: str = "pm25",
    keys: Sequence[str] = KEYS,
    every: str = "YEAR",
) -> DataFrame:
    """Fill missing values by `ffill`, `interpolate` or `drop`; rows still null are dropped."""
    if method == "drop":
        return df.filter(F.col(value).isNotNull())
    if method == "ffill":
        return _forward_back_fill(df, order, value, keys, every)
    if method == "interpolate":
        return _interpolate(df, order, value, keys, every)
    raise ValueError(f"unknown fill method: {method}")


def _forward_back_fill(df, order, value, keys, every):
    edged = _with_edges(df, value, order, keys, every, F.col(value))
    within = Window.partitionBy(*keys, "_seg")
    running = within.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # only the leading gap of a station is still null after the forward fill and the carry
    first_here = F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).over(within)
    filled = F.coalesce(
        F.last(value, ignorenulls=True).over(running), F.col("_carry"), first_here, F.col("_next")
    )
    return edged.select(
        *[filled.alias(value) if c == value else F.col(c) for c in df.columns]
    ).filter(F.col(value).isNotNull())


def _interpolate(df, order, value, keys, every):
    numbered = positioned(df, order, keys, every, pos="_pos")
    point = F.struct(F.col("_pos").alias("pos"), F.col(value).alias("v"))
    edged = _with_edges(numbered, value, order, keys, every, point).withColumn(
        "_point", F.when(F.col(value).isNotNull(), point)
    )
    within = Window.partitionBy(*keys, "_seg")
    ahead = within.orderBy(F.col(order).desc())
    behind = within.orderBy(order)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    before = F.coalesce(
        F.last("_point", ignorenulls=True).over(behind.rowsBetween(*so_far)), F.col("_carry")
    )
    after = F.coalesce(
        F.last("_point", ignorenulls=True).over(ahead.rowsBetween(*so_far)), F.col("_next")
    )
    placed = edged.withColumn("_b", before).withColumn("_a", after)
    b, a = F.col("_b"), F.col("_a")
    share = (F.col("_pos") - b["pos"]) / (a["pos"] - b["pos"])
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(b.isNull(), a["v"])
        .when(a.isNull(), b["v"])
        .otherwise(b["v"] + (a["v"] - b["v"]) * share)
    )
    return placed.select(
        *[filled.alias(value) if c == value else F.col(c) for c in df.columns]
    ).filter(F.col(value).isNotNull())


def fill_flagged(
    df: DataFrame,
    order: str = "date",
    value: str = "pm25",
    keys: Sequence[str] = KEYS,
    every: str = "YEAR",
) -> DataFrame:
    """Forward fill only; keeps the observed value and flags the filled rows."""
    edged = _with_edges(df, value, order, keys, every, F.col(value))
    running = (
        Window.partitionBy(*keys, "_seg")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = F.coalesce(F.last(value, ignorenulls=True).over(running), F.col("_carry"))
    observed = f"{value}_observed"
    return (
        edged.withColumn(observed, F.col(value))
        .withColumn(value, filled)
        .withColumn("was_filled", F.col(observed).isNull() & F.col(value).isNotNull())
        .drop("_seg", "_carry", "_next")
    )


def fill_limited(
    df: DataFrame,
    limit: int,
    order: str = "date",
    value: str = "pm25",
    keys: Sequence[str] = KEYS,
    every: str = "YEAR",
) -> DataFrame:
    """Fill from at most `limit` rows back, then from at most `limit` rows ahead."""
    numbered = positioned(df, order, keys, every, pos="_pos")

    def columns(w):
        ahead = Window.partitionBy(*keys, "_chunk").orderBy(F.col("_pos").desc())
        return {
            "_back": F.last(value, ignorenulls=True).over(w.rowsBetween(-limit, 0)),
            "_ahead": F.last(value, ignorenulls=True).over(ahead.rowsBetween(-limit, 0)),
        }

    spread = over_chunks(numbered, columns, "_pos", back=limit, ahead=limit, keys=keys)
    return spread.withColumn(value, F.coalesce("_back", "_ahead")).select(*df.columns)


def preprocess(
    df: DataFrame,
    method: str = "ffill",
    bounds: tuple[float, float] = (0.0, 500.0),
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Daily cleaning: fill first, then drop values outside the bounds."""
    return remove_outliers(fill_series(df, method, keys=keys), *bounds)


def missing_report(
    before: DataFrame, after: DataFrame, value: str = "pm25", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Missing values per station before and after a fill, in one aggregate."""
    count = lambda df, name, other: df.select(
        *keys,
        F.col(value).isNull().cast("bigint").alias(name),
        F.lit(0).cast("bigint").alias(other),
    )
    both = count(before, "missing_before", "missing_after").unionByName(
        count(after, "missing_after", "missing_before")
    )
    return both.groupBy(*keys).agg(
        F.sum("missing_before").alias("missing_before"),
        F.sum("missing_after").alias("missing_after"),
    )
