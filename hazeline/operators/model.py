"""Splits, selection, scoring and forecast jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.functions.parsing import LOCAL_TZ, day_bounds
from hazeline.functions.scalar import valid_history
from hazeline.operators.aggregate import daily_local_mean, regression_metrics
from hazeline.operators.features import (
    HORIZON_HOURS,
    build_hourly_features,
    history_features,
    latest,
    latest_report,
)
from hazeline.operators.upsert import dedupe_first, replace_predictions
from hazeline.plans.series import KEYS, positioned

# Split lengths in months, history and buffer lengths in days, forecast inputs.
SPLIT_MONTHS = {"data_start": 42, "val_start": 6, "test_start": 3}
HISTORY_DAYS = 15
FILL_LOOKBACK_DAYS = 7
SCHEDULE_BUFFER_DAYS = 30
FORECAST_HOURS, FORECAST_MIN_HOURS = 48, 30


def relative_splits(as_of: Column) -> dict[str, Column]:
    """Split borders (dates) relative to a day: data, validation and test start, data end."""
    borders = {
        name: F.add_months(as_of.cast("date"), -months) for name, months in SPLIT_MONTHS.items()
    }
    return {**borders, "test_end": as_of.cast("date")}


def assign_split(
    df: DataFrame,
    val_start: Column,
    test_start: Column,
    data_start: Column | None = None,
    order: str = "ts",
    purge_hours: int = 0,
) -> DataFrame:
    """Add `split`: train, val or test by time; rows before `data_start` are dropped.

    `purge_hours` leaves out the rows just before a border whose target lies behind it.
    """
    at = F.col(order)
    rows = df if data_start is None else df.filter(at >= data_start)
    split = F.when(at < val_start, "train").when(at < test_start, "val").otherwise("test")
    rows = rows.withColumn("split", split)
    if not purge_hours:
        return rows
    ahead = at + F.make_dt_interval(hours=F.lit(purge_hours))
    crosses = ((at < val_start) & (ahead >= val_start)) | ((at < test_start) & (ahead >= test_start))
    return rows.filter(~crosses)


def time_folds(
    df: DataFrame, k: int = 3, order: str = "ts", keys: Sequence[str] = KEYS, every: str = "MONTH"
) -> DataFrame:
    """Add `block` 0..k for k expanding folds: fold i tests block i and trains on all before it.

    Test blocks have n div (k+1) rows; block 0 takes the rest. A block number instead of copied
    fold rows keeps the table at its size.
    """
    numbered = positioned(df, order, keys, every, pos="_pos", total="_n")
    size = F.floor(F.col("_n") / (k + 1))
    into = F.col("_pos") - 1 - (F.col("_n") - k * size)
    block = F.when(into < 0, 0).otherwise(F.floor(into / size) + 1).cast("int")
    return numbered.withColumn("block", block).drop("_pos", "_n")


def fold_sizes(blocked: DataFrame, k: int = 3, order: str = "ts", keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, fold, role, rows, first, last) of expanding folds, from per-block counts."""
    per_block = blocked.groupBy(*keys, "block").agg(
        F.count("*").alias("_n"), F.min(order).alias("_first"), F.max(order).alias("_last")
    )
    folds = F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(k))
    spread = per_block.withColumn("fold", F.explode(folds))
    role = F.when(F.col("fold") == F.col("block"), "test").otherwise("train")
    return spread.groupBy(*keys, "fold", role.alias("role")).agg(
        F.sum("_n").alias("rows"), F.min("_first").alias("first"), F.max("_last").alias("last")
    )


def linear_score(coefficients: Mapping[str, float], intercept: float = 0.0) -> Column:
    """A linear model as a column expression, so scoring stays inside code generation."""
    score = F.lit(float(intercept))
    for name, weight in coefficients.items():
        score = score + F.col(name) * F.lit(float(weight))
    return score


def score_batch(
    features: DataFrame, models: Mapping[str, Column], actual: str, order: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """(keys, order, actual, model, predicted): every model over the same rows in one pass."""
    wide = features.select(*keys, order, F.col(actual).alias("actual"), *[c.alias(n) for n, c in models.items()])
    return wide.unpivot([*keys, order, "actual"], list(models), "model", "predicted")


def score_candidates(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return regression_metrics(scored, [*keys, "model"])


def champion(metrics: DataFrame, metric: str = "rmse", keys: Sequence[str] = KEYS) -> DataFrame:
    """Lowest metric per station; the model name breaks ties."""
    return dedupe_first(metrics, keys, [metric, "model"])


def promote(
    challenger: DataFrame, production: DataFrame, margin: float = 0.0, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Deploy when there is no production model or the new RMSE is strictly lower (by `margin`)."""
    old = production.select(*keys, F.col("rmse").alias("old_rmse"), F.col("mae").alias("old_mae"))
    better = F.col("old_rmse").isNull() | (F.col("rmse") < F.col("old_rmse") * (1 - margin))
    return challenger.join(old, list(keys), "left").select(
        *keys,
        "model",
        "rmse",
        "mae",
        "old_rmse",
        F.round(F.col("old_rmse") - F.col("rmse"), 4).alias("delta_rmse"),
        F.round(F.col("old_mae") - F.col("mae"), 4).alias("delta_mae"),
        F.when(better, "DEPLOYED").otherwise("NOT_DEPLOYED").alias("status"),
    )


def registry_update(registry: DataFrame, promoted: DataFrame, version: int) -> DataFrame:
    """Append the deployed models as a new version."""
    entries = promoted.filter(F.col("status") == "DEPLOYED").select(
        "station", F.col("model").alias("model_key"), "rmse", "mae", F.lit(version).alias("version")
    )
    return registry.unionByName(entries)


def active_models(registry: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return latest_report(registry, "version", keys)


def training_report(promoted: DataFrame, splits: DataFrame, run_date: Column) -> DataFrame:
    """One row per station and run: training range, best model, metrics, status."""
    spans = splits.filter(F.col("split") == "train").groupBy("station").agg(
        F.min("ts").cast("date").alias("train_start"), F.max("ts").cast("date").alias("train_end")
    )
    return promoted.join(spans, "station", "left").select(
        "station",
        "train_start",
        "train_end",
        F.col("model").alias("best_model"),
        "rmse",
        "mae",
        "old_rmse",
        "delta_rmse",
        "status",
        run_date.cast("date").alias("run_date"),
    )


def explode_history(requests: DataFrame, key: str = "request") -> DataFrame:
    """(request, date, pm25) of the requests that pass the history check."""
    good = requests.filter(valid_history(F.col("history")))
    return good.select(key, F.explode("history").alias("_h")).select(key, "_h.date", "_h.pm25")


def forecast_next_day(
    requests: DataFrame, score: Column, key: str = "request", compat: bool = False, places: int = 2
) -> DataFrame:
    """(request, prediction_date, predicted) from histories of at least 15 days.

    The features are those of the day after the last reading, so lag 1 is that reading. `compat`
    takes the features of the last history day instead and labels the score with the next day.
    All features come from the request's own array, so this is a map without any shuffle.
    """
    good = requests.filter(valid_history(F.col("history")))
    ordered = good.select(key, F.array_sort("history").alias("_h"))
    last = F.element_at("_h", -1)["date"]
    readings = F.transform("_h", lambda h: h["pm25"])
    day = last if compat else F.date_add(last, 1)
    used = F.slice(readings, 1, F.size(readings) - 1) if compat else readings
    prepared = ordered.select(key, used.alias("_values"), day.alias("_day"))
    rows = prepared.select(
        key,
        (F.date_add("_day", 1) if compat else F.col("_day")).alias("prediction_date"),
        *[c.alias(n) for n, c in history_features(F.col("_values"), F.col("_day")).items()],
    )
    return rows.select(key, "prediction_date", F.round(score, places).alias("predicted"))


def job_days(today: str, start: str | None = None, end: str | None = None) -> tuple[Column, Column]:
    """The first and last local day that `prediction_jobs` needs."""
    day = lambda text: F.lit(text).cast("date")
    if start is not None:
        return F.date_sub(day(start), HISTORY_DAYS + FILL_LOOKBACK_DAYS), F.date_sub(day(end), 1)
    return F.date_sub(day(today), HISTORY_DAYS + FILL_LOOKBACK_DAYS + SCHEDULE_BUFFER_DAYS), day(today)


def job_bounds(spark: SparkSession, today: str, start: str | None = None, end: str | None = None, tz: str = LOCAL_TZ) -> tuple[str, str]:
    """The times [since, until) that `prediction_jobs` needs, for a reader that takes them."""
    since, until = day_bounds(*job_days(today, start, end), tz)
    row = spark.range(1).select(since.cast("string").alias("since"), until.cast("string").alias("until")).first()
    return row["since"], row["until"]


def prediction_jobs(
    readings: DataFrame,
    stations: DataFrame,
    today: str,
    start: str | None = None,
    end: str | None = None,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """One row per (station, target date) with its 15-day history, or one with a skip reason.

    Read `readings` with the times of `job_bounds`, so that they reach the scan. With `start` and `end` the run is manual; without them every station gets the day after its
    latest reading.
    """
    manual = start is not None
    day = lambda text: F.lit(text).cast("date")
    first, last = job_days(today, start, end)
    start_ts, end_ts = day_bounds(first, last, tz)
    means = daily_local_mean(readings.filter((F.col("ts") >= start_ts) & (F.col("ts") < end_ts)), tz=tz)
    # at most one row per station and day of the requested range, so a plain window is bounded
    series = Window.partitionBy("station")
    by_date = series.orderBy("date")
    spans = means.select(
        "station",
        "date",
        "pm25",
        F.when(F.lag("date").over(by_date).isNull(), first).otherwise(F.col("date")).alias("_from"),
        # one day past the range, because the target may be the day after it
        F.coalesce(F.date_sub(F.lead("date").over(by_date), 1), F.date_add(last, 1)).alias("_to"),
        F.max("date").over(series).alias("_latest"),
    )
    days = spans.withColumn("day", F.explode(F.sequence("_from", "_to"))).select(
        "station",
        "_latest",
        "day",
        F.when(F.col("day") >= F.col("date"), F.col("pm25")).alias("pm25"),
        (F.col("day") > F.col("date")).alias("_filled"),
    )
    back = series.orderBy("day").rowsBetween(-HISTORY_DAYS, -1)
    windows = days.select(
        "station",
        "_latest",
        "day",
        F.collect_list(F.struct(F.col("day").alias("date"), "pm25")).over(back).alias("history"),
        F.count_if(F.col("pm25").isNull()).over(back).alias("_missing"),
        F.count_if("_filled").over(back).alias("filled_history_days"),
    )
    next_day = F.date_add("_latest", 1)
    if manual:
        from_day, to_day = day(start), F.least(day(end), next_day)
        early = from_day > next_day
    else:
        from_day, to_day, early = next_day, next_day, F.lit(False)
    target = F.col("day").between(from_day, to_day)
    # a station whose start is too late keeps one row to carry the reason
    kept = windows.filter(target | (early & (F.col("day") == F.col("_latest"))))
    reason = (
        F.when(F.col("_latest").isNull(), "no_daily_data")
        .when(early, "requested_start_beyond_latest_history")
        .when(F.size("history") != HISTORY_DAYS, "insufficient_history_window")
        .when(F.col("_missing") > 0, "history_contains_missing_pm25")
    )
    joined = stations.select("station").distinct().join(kept, "station", "left")
    ready = reason.isNull()
    return joined.select(
        "station",
        F.when(F.col("_latest").isNotNull() & ~early, F.col("day")).alias("target_date"),
        reason.alias("skip_reason"),
        F.when(ready, F.date_sub("day", HISTORY_DAYS)).alias("history_start_date"),
        F.when(ready, F.date_sub("day", 1)).alias("history_end_date"),
        F.when(ready, F.col("filled_history_days")).alias("filled_history_days"),
        F.when(ready, F.col("history")).alias("history"),
    )


def job_predictions(jobs: DataFrame, score: Column, model: str, run_type: str, generated_at: Column) -> DataFrame:
    """Forecasts of the ready jobs with their lineage columns."""
    ready = jobs.filter(F.col("skip_reason").isNull())
    lineage = ["station", "target_date", "history_start_date", "history_end_date", "filled_history_days"]
    forecasts = forecast_next_day(ready.select(F.struct(*lineage).alias("request"), "history"), score)
    return forecasts.select(
        "request.station",
        "prediction_date",
        F.col("predicted").alias("predicted_pm25"),
        F.lit(HISTORY_DAYS).alias("history_days"),
        *[f"request.{name}" for name in lineage[2:]],
        F.lit(model).alias("model"),
        F.lit(run_type).alias("run_type"),
        generated_at.alias("prediction_generated_at"),
    )


def store_predictions(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The prediction table after replacing the exact keys of the new rows."""
    anyday = F.lit("1970-01-01").cast("date")
    return replace_predictions(table, rows, anyday, anyday, ["prediction_generated_at"])


def forecast_latest(
    series: DataFrame, score: Callable[[DataFrame], DataFrame], places: int = 2
) -> DataFrame:
    """Forecast 24 hours ahead for every station from its last 48 hours (at least 30)."""
    count = F.count("*").over(Window.partitionBy("station"))  # at most 48 rows are left
    recent = latest(series, FORECAST_HOURS, "hour").withColumn("_n", count)
    enough = recent.filter(F.col("_n") >= FORECAST_MIN_HOURS).drop("recency", "_n")
    features = build_hourly_features(enough, target=False)
    last = score(latest_report(features, "ts"))
    return last.select(
        "station",
        F.col("ts").alias("base_ts"),
        (F.col("ts") + F.make_dt_interval(hours=F.lit(HORIZON_HOURS))).alias("forecast_ts"),
        F.round("predicted", places).alias("predicted"),
    )
