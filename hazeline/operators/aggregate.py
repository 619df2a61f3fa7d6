"""Summaries and metrics (A1-A18). Every aggregate has a map-side part; percentiles are exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.parsing import LOCAL_TZ, day_bounds, local_date
from hazeline.functions.scalar import aq_band, regime, round_half_up
from hazeline.operators.features import CORRELATION_LAGS, lag_columns
from hazeline.plans.quantiles import exact_percentiles
from hazeline.plans.series import KEYS, over_chunks, positioned
from hazeline.session import stage_table

DRY_MONTHS = (1, 2, 3, 4, 11, 12)  # fixed value: November to April


def daily_mean(hourly: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return hourly.groupBy(*keys, F.col("ts").cast("date").alias("date")).agg(
        F.avg("pm25").alias("pm25")
    )


def daily_local_mean(
    readings: DataFrame,
    first: str | None = None,
    last: str | None = None,
    tz: str = LOCAL_TZ,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Mean per local date, rounded to 2 as a decimal, with the count of non-null readings."""
    rows = readings.filter(F.col("pm25").isNotNull())
    if first is not None:
        # bounds on the raw time, so that they reach the scan
        start, end = day_bounds(F.lit(first).cast("date"), F.lit(last).cast("date"), tz)
        rows = rows.filter((F.col("ts") >= start) & (F.col("ts") < end))
    rows = rows.withColumn("date", local_date(F.col("ts"), tz))
    return rows.groupBy(*keys, "date").agg(
        round_half_up(F.avg("pm25"), 2).alias("pm25"), F.count("pm25").alias("hourly_points")
    )


def row_count(df: DataFrame, station: str | None = None) -> DataFrame:
    rows = df if station is None else df.filter(F.col("station") == station)
    return rows.agg(F.count("*").alias("rows"))


def coverage(df: DataFrame, order: str = "ts", keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        (F.count("*") / 24).alias("days"),
        F.min(order).alias("first"),
        F.max(order).alias("last"),
    )


def regression_metrics(
    pairs: DataFrame,
    by: Sequence[str] = KEYS,
    actual: str = "actual",
    predicted: str = "predicted",
    places: int = 4,
) -> DataFrame:
    """n, MAE, RMSE and R2, rounded. SST comes from the population variance, which Spark
    merges in a numerically stable way."""
    rows = pairs.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(actual) - F.col(predicted)
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("_mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(actual).alias("_var"),
    )
    metrics = metric_columns(F.col("n"), F.col("_mae"), F.col("_mse"), F.col("_var"), places)
    return sums.select(*by, "n", *metrics)


def metric_columns(
    n: Column, mae: Column, mse: Column, variance: Column, places: int = 4
) -> list[Column]:
    """MAE, RMSE and R2 from mean errors and the population variance of the actuals.

    R2 needs two rows; constant actuals give 1 for a perfect fit and 0 otherwise.
    """
    flat = F.when(mse == 0, 1.0).otherwise(0.0)
    r2 = F.when(n >= 2, F.when(variance == 0, flat).otherwise(1 - F.try_divide(mse, variance)))
    return [
        F.round(mae, places).alias("mae"),
        F.round(F.sqrt(mse), places).alias("rmse"),
        F.round(r2, places).alias("r2"),
    ]


def mape(pairs: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Mean absolute percentage error over positive actuals."""
    share = F.abs(F.col("actual") - F.col("predicted")) / F.col("actual")
    return pairs.groupBy(*by).agg(
        (F.avg(F.when(F.col("actual") > 0, share)) * 100).alias("mape")
    )


def bias(pairs: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    return pairs.groupBy(*by).agg(
        F.avg(F.col("predicted") - F.col("actual")).alias("bias"), F.count("*").alias("pairs")
    )


def bias_of_raw_pairs(raw: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Bias over all pairs of `pair_raw`."""
    return raw.groupBy(*by).agg(
        F.sum("pairs").alias("pairs"), (F.sum("error_sum") / F.sum("pairs")).alias("bias")
    )


def metrics_by_regime(
    pairs: DataFrame, by: Sequence[str] = KEYS, places: int = 4
) -> DataFrame:
    """Metrics and the 95th percentile of the absolute error per pollution regime."""
    rows = pairs.withColumn("regime", regime(F.col("actual"))).withColumn(
        "_abs", F.abs(F.col("actual") - F.col("predicted"))
    )
    keys = [*by, "regime"]
    tail = exact_percentiles(rows, "_abs", [0.95], keys)
    return regression_metrics(rows, keys, places=places).join(
        tail.select(*keys, F.col("q")[0].alias("p95_error")), keys
    )


def describe_by_station(df: DataFrame, value: str = "pm25", keys: Sequence[str] = KEYS) -> DataFrame:
    base = df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_percentiles(df, value, [0.25, 0.5, 0.75], keys)
    q = F.col("q")
    return base.join(
        quartiles.select(*keys, q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75")), list(keys)
    )


def histogram(
    df: DataFrame, bins: int = 30, value: str = "pm25", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Equal-width counts over min..max per station; the last bin is closed; empty bins stay."""
    spans = stage_table(
        df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")), "spans"
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    slots = spans.select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.col("_lo"),
        width.alias("_width"),
    )
    place = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width))
    counted = (
        df.join(spans, list(keys))
        .filter(F.col(value).isNotNull())
        .select(
            *keys,
            F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(bins - 1))
            .cast("int")
            .alias("bin"),
        )
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("_n"))
    )
    return slots.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("left_edge"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("count"),
    )


def box_by_month(daily: DataFrame, value: str = "pm25", keys: Sequence[str] = KEYS) -> DataFrame:
    """Quartiles per calendar month and the outermost values within 1.5 IQR of the box."""
    rows = daily.filter(F.col(value).isNotNull()).withColumn("month", F.month("date"))
    group = [*keys, "month"]
    q = F.col("q")
    quartiles = stage_table(
        exact_percentiles(rows, value, [0.25, 0.5, 0.75], group).select(
            *group, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")
        ),
        "quartiles",
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.join(quartiles, group).groupBy(*group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def season_stats(daily: DataFrame, value: str = "pm25", keys: Sequence[str] = KEYS) -> DataFrame:
    season = F.when(F.month("date").isin(*DRY_MONTHS), "dry").otherwise("wet")
    return daily.groupBy(*keys, season.alias("season")).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("days")
    )


def lag_correlation(
    daily: DataFrame, lags: Sequence[int] = CORRELATION_LAGS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Correlation matrix of the value and its lags, as rows (keys, left, right, r).

    Missing values are dropped before lagging; only rows with every lag count.
    """
    numbered = positioned(daily.filter(F.col("pm25").isNotNull()), "date", keys, pos="_pos")
    wide = over_chunks(
        numbered, lambda w: lag_columns(w, lags), "_pos", back=max(lags), keys=keys
    ).dropna()
    names = ["pm25", *[f"pm25_lag_{n}" for n in lags]]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    wide = wide.groupBy(*keys).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot(list(keys), [f"{a}|{b}" for a, b in pairs], "_pair", "r")
    names = F.split("_pair", r"\|")
    return long.select(*keys, names[0].alias("left"), names[1].alias("right"), "r")


def missing_pct(long: DataFrame, value: str = "pm25", keys: Sequence[str] = KEYS) -> DataFrame:
    """Share of missing values per station in percent, with flags above 10 and below 2."""
    pct = F.avg(F.col(value).isNull().cast("double")) * 100
    return (
        long.groupBy(*keys)
        .agg(pct.alias("missing_pct"))
        .withColumn("above_10", F.col("missing_pct") > 10)
        .withColumn("below_2", F.col("missing_pct") < 2)
    )


def forecast_summary(forecasts: DataFrame, value: str = "predicted") -> DataFrame:
    """One row: mean forecast, highest and lowest station (first by name on ties), and its band."""
    by_high = F.struct(F.col(value), F.col("station"))
    top = forecasts.agg(
        F.count("*").alias("stations"),
        F.avg(value).alias("mean_forecast"),
        F.max(value).alias("highest"),
        F.min_by("station", F.struct(-F.col(value), F.col("station"))).alias("highest_station"),
        F.min(value).alias("lowest"),
        F.min_by("station", by_high).alias("lowest_station"),
    )
    return top.withColumn("band", aq_band(F.col("mean_forecast")))


def pair_stats(pairs: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    return pairs.groupBy(*by).agg(
        F.count("*").alias("pairs"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.avg("predicted").alias("predicted_mean"),
        F.stddev_samp("predicted").alias("predicted_std"),
        F.avg("actual").alias("actual_mean"),
        F.stddev_samp("actual").alias("actual_std"),
    )


def ingest_metrics(checked: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row per run: fetched, failed, stored and skipped rows, and the pass rate."""
    marks = checked.select(F.when(F.col("is_valid"), "valid").otherwise("failed").alias("_k")).unionAll(
        inserted.select(F.lit("stored").alias("_k"))
    )
    count = lambda kind: F.count_if(F.col("_k") == kind)
    fetched = count("valid") + count("failed")
    return marks.agg(
        fetched.alias("fetched_records"),
        count("failed").alias("validation_failures"),
        count("stored").alias("stored_records"),
        (count("valid") - count("stored")).alias("duplicates_skipped"),
        F.coalesce(F.try_divide(count("valid").cast("double"), fetched), F.lit(0.0)).alias(
            "validation_pass_rate"
        ),
    )


def hourly_missing_rate(grid: DataFrame) -> DataFrame:
    """Share of stations without a reading, per hour of the grid."""
    return grid.groupBy("ts").agg(
        F.count("*").alias("stations"),
        F.avg(F.col("pm25").isNull().cast("double")).alias("missing_rate"),
    )


def anomaly_count(
    df: DataFrame, low: float = 0.0, high: float = 500.0, keys: Sequence[str] = KEYS
) -> DataFrame:
    value: Column = F.col("pm25")
    return df.groupBy(*keys).agg(F.count_if((value < low) | (value > high)).alias("anomalies"))
