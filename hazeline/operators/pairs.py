"""Joins of predictions, actuals and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.operators.upsert import dedupe_latest

PAIR_KEYS = ("station", "date")


def pair_predictions(
    predictions: DataFrame, actuals: DataFrame, order: Sequence[str], keys: Sequence[str] = PAIR_KEYS
) -> DataFrame:
    """(keys, predicted, actual): the latest entry per key on each side, inner join."""
    newest_p = dedupe_latest(predictions, keys, order).select(*keys, "predicted")
    newest_a = dedupe_latest(actuals, keys, order).select(*keys, "actual")
    return newest_p.join(newest_a, list(keys))


def pair_raw(
    predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = PAIR_KEYS
) -> DataFrame:
    """Statistics of the join without deduplication, per key: `pairs`, `error_sum` of
    (predicted - actual), and the value sums.

    The many-to-many join itself is never built: with n and sum of each side, the pair count is
    the product of the counts and the summed error is n_a * sum(p) - n_p * sum(a).
    """
    side = lambda df, value, n, total: df.groupBy(*keys).agg(
        F.count(value).alias(n), F.sum(value).alias(total)
    )
    joined = side(predictions, "predicted", "_np", "_sp").join(
        side(actuals, "actual", "_na", "_sa"), list(keys)
    )
    return joined.select(
        *keys,
        (F.col("_np") * F.col("_na")).alias("pairs"),
        (F.col("_na") * F.col("_sp") - F.col("_np") * F.col("_sa")).alias("error_sum"),
    )


def raw_pairs(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """(keys, predicted, actual, absolute_error): the join without deduplication, one row per pair.

    The fan-out of a key is its re-runs times its recorded values.
    """
    joined = predictions.select(*keys, "predicted").join(actuals.select(*keys, "actual"), list(keys))
    return joined.withColumn("absolute_error", F.abs(F.col("actual") - F.col("predicted")))


def match_actuals(
    actuals: DataFrame,
    predictions: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = PAIR_KEYS,
    places: int = 4,
) -> DataFrame:
    """Every actual with the last prediction of its key and the absolute error, null if none."""
    last = dedupe_latest(predictions, keys, order).select(
        *keys, F.col("predicted").alias("matched_prediction")
    )
    return actuals.join(last, list(keys), "left").withColumn(
        "absolute_error", F.round(F.abs(F.col("actual") - F.col("matched_prediction")), places)
    )


def with_station_names(readings: DataFrame, names: DataFrame, key: str = "station_id") -> DataFrame:
    """Left join to the name table; Spark broadcasts it while it is below its size threshold."""
    return readings.join(names.select(key, "station_name", "station_name_en"), key, "left")


def rolling_pairs(
    predictions: DataFrame,
    actuals: DataFrame,
    as_of: Column,
    days: int = 14,
    created: str = "created_at",
    keys: Sequence[str] = PAIR_KEYS,
) -> DataFrame:
    """Predictions created in the last `days` days joined to the actuals of their day."""
    recent = predictions.filter(F.col(created) >= as_of - F.make_dt_interval(days=F.lit(days)))
    return recent.join(actuals, list(keys))
