"""Deduplication, upsert and delete as DataFrame transformations.

Each returns the new table content; writing it is a sink's job. Hot keys are safe: deduplication
keeps one row per key and task before the shuffle, and anti joins compare keys that are unique on
one side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READING_KEYS = ("station", "ts")
PREDICTION_KEYS = ("prediction_date", "station")


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest `order` per key; further columns break ties."""
    return _first_by(df, keys, [F.col(c).desc() for c in order])


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _first_by(df, keys, [F.col(c).asc() for c in order])


def new_rows(
    target: DataFrame, batch: DataFrame, order: Sequence[str], keys: Sequence[str] = READING_KEYS
) -> DataFrame:
    """The batch rows an insert-ignore would store: first per key and not in the target."""
    return dedupe_first(batch, keys, order).join(target.select(*keys), list(keys), "left_anti")


def insert_ignore(
    target: DataFrame, batch: DataFrame, order: Sequence[str], keys: Sequence[str] = READING_KEYS
) -> DataFrame:
    """Target plus the new batch rows; existing rows win."""
    return target.unionByName(new_rows(target, batch, order, keys))


def insert_counts(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: inserted and duplicate counts of an insert-ignore."""
    marks = batch.select(F.lit(1).alias("_all"), F.lit(0).alias("_new")).unionAll(
        inserted.select(F.lit(0).alias("_all"), F.lit(1).alias("_new"))
    )
    total = F.coalesce(F.sum("_all"), F.lit(0)).cast("bigint")
    stored = F.coalesce(F.sum("_new"), F.lit(0)).cast("bigint")
    return marks.agg(stored.alias("inserted"), (total - stored).alias("duplicates"))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = PREDICTION_KEYS,
) -> DataFrame:
    """Batch rows replace target rows of the same key; inside a batch the latest wins."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(dedupe_latest(batch, keys, order))


def _of_stations(stations: Sequence | None, column: str) -> Column:
    return F.lit(True) if stations is None else F.col(column).isin(list(stations))


def in_range(
    start: Column, end: Column, stations: Sequence | None = None, order: str = "ts"
) -> Column:
    """Predicate of a half-open time range, optionally for some stations."""
    return (F.col(order) >= start) & (F.col(order) < end) & _of_stations(stations, "station")


def in_date_range(
    first: Column, last: Column, stations: Sequence | None = None, order: str = "prediction_date"
) -> Column:
    """Predicate of an inclusive date range, optionally for some stations."""
    return F.col(order).between(first, last) & _of_stations(stations, "station")


def delete_where(df: DataFrame, doomed: Column) -> DataFrame:
    """SQL DELETE: rows go only where the predicate is true, so unknown (null) rows stay."""
    return df.filter(~F.coalesce(doomed, F.lit(False)))


def delete_range(df, start, end, stations=None, order="ts") -> DataFrame:
    return delete_where(df, in_range(start, end, stations, order))


def delete_date_range(df, first, last, stations=None, order="prediction_date") -> DataFrame:
    return delete_where(df, in_date_range(first, last, stations, order))


def delete_keys(
    df: DataFrame, batch: DataFrame, keys: Sequence[str] = PREDICTION_KEYS
) -> DataFrame:
    """Delete the exact keys of a batch; null keys delete nothing."""
    return df.join(batch.select(*keys).dropna().distinct(), list(keys), "left_anti")


def replace_range(
    target: DataFrame,
    batch: DataFrame,
    start: Column,
    end: Column,
    order: Sequence[str],
    stations: Sequence | None = None,
    keys: Sequence[str] = READING_KEYS,
) -> DataFrame:
    """Delete a time range, then insert-ignore the batch."""
    kept = delete_range(target, start, end, stations)
    return insert_ignore(kept, batch, order, keys)


def replace_range_counts(
    target: DataFrame,
    batch: DataFrame,
    start: Column,
    end: Column,
    order: Sequence[str],
    stations: Sequence | None = None,
    keys: Sequence[str] = READING_KEYS,
) -> DataFrame:
    """One row: deleted, inserted and duplicate counts of a `replace_range`."""
    doomed = target.filter(in_range(start, end, stations))
    fresh = new_rows(delete_range(target, start, end, stations), batch, order, keys)
    marks = None
    for kind, rows in (("_del", doomed), ("_all", batch), ("_new", fresh)):
        part = rows.select(F.lit(kind).alias("_kind"))
        marks = part if marks is None else marks.unionAll(part)
    count = lambda kind: F.count_if(F.col("_kind") == kind)
    return marks.agg(
        count("_del").alias("deleted"),
        count("_new").alias("inserted"),
        (count("_all") - count("_new")).alias("duplicates"),
    )


def replace_predictions(
    target: DataFrame,
    batch: DataFrame | None,
    first: Column,
    last: Column,
    order: Sequence[str],
    stations: Sequence | None = None,
    keys: Sequence[str] = PREDICTION_KEYS,
) -> DataFrame:
    """With a batch, its exact keys are replaced; without one, the date range is deleted.

    The upsert drops the old rows of the batch's keys itself, so no separate delete runs.
    """
    if batch is None:
        return delete_date_range(target, first, last, stations)
    return upsert(target, batch, order, keys)


def key_exists(batch: DataFrame, target: DataFrame, keys: Sequence[str] = READING_KEYS) -> DataFrame:
    """The batch with `exists`: whether its key is in the target."""
    marks = target.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return batch.join(marks, list(keys), "left").withColumn(
        "exists", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")
