"""Recent-data checks (M1-M4). `as_of` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.session import stage_table


def _hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))


def recent_quality(
    readings: DataFrame, stations: DataFrame, as_of: Column, hours: int = 24
) -> DataFrame:
    """Rows, null rate, outliers (> mean + 2 std), mean, std and alert of the last hours.

    Every station of `stations` appears; one without rows reports NO_DATA.
    """
    recent = readings.filter((F.col("ts") > as_of - _hours(hours)) & (F.col("ts") <= as_of))
    stats = stage_table(
        recent.groupBy("station").agg(
            F.count("*").alias("records_count"),
            F.count("pm25").alias("_present"),
            F.avg("pm25").alias("_mean"),
            F.coalesce(F.stddev_samp("pm25"), F.lit(0.0)).alias("_std"),
        ),
        "stats",
    )
    # a mean of zero counts as "no mean" in the checks, as it does where these rules come from
    outliers = (
        recent.join(stats, "station")
        .filter((F.col("_mean") != 0) & (F.col("pm25") > F.col("_mean") + 2 * F.col("_std")))
        .groupBy("station")
        .agg(F.count("*").alias("outliers"))
    )
    joined = (
        stations.select("station").distinct().join(stats, "station", "left").join(outliers, "station", "left")
    )
    rows = F.coalesce("records_count", F.lit(0))
    null_rate = F.coalesce(1 - F.try_divide(F.col("_present").cast("double"), rows), F.lit(1.0))
    found = F.coalesce("outliers", F.lit(0))
    alert = (
        F.when(rows == 0, "NO_DATA")
        .when(null_rate > 0.5, "HIGH_NULL_RATE")
        .when(found > F.col("_present") * 0.1, "HIGH_OUTLIERS")
        .when(F.col("_mean") > 400, "EXTREME_VALUES")
        .otherwise("OK")
    )
    return joined.select(
        "station",
        rows.cast("bigint").alias("records_count"),
        null_rate.alias("null_rate"),
        found.cast("bigint").alias("outliers"),
        F.when(F.col("_mean") != 0, F.round("_mean", 2)).alias("mean_pm25"),
        F.round("_std", 2).alias("std_pm25"),
        alert.alias("alert_level"),
    )


def sensor_drift(
    readings: DataFrame,
    stations: DataFrame,
    as_of: Column,
    current_hours: int = 1,
    baseline_hours: int = 7 * 24,
) -> DataFrame:
    """Mean of the last hours against the baseline before them; one conditional aggregate."""
    border = as_of - _hours(current_hours)
    since = as_of - _hours(current_hours + baseline_hours)
    window = readings.filter((F.col("ts") > since) & (F.col("ts") <= as_of))
    means = window.groupBy("station").agg(
        F.avg(F.when(F.col("ts") > border, F.col("pm25"))).alias("current"),
        F.avg(F.when(F.col("ts") <= border, F.col("pm25"))).alias("baseline"),
    )
    joined = stations.select("station").distinct().join(means, "station", "left")
    usable = (F.col("current") != 0) & (F.col("baseline") != 0)
    pct = F.when(usable, F.try_divide(F.col("current") - F.col("baseline"), F.col("baseline")) * 100)
    alert = (
        F.when(pct.isNull(), "INSUFFICIENT_DATA")
        .when(F.abs(pct) > 50, "SEVERE_DRIFT")
        .when(F.abs(pct) > 25, "MODERATE_DRIFT")
        .otherwise("OK")
    )
    return joined.select(
        "station",
        F.round("current", 2).alias("current_mean"),
        F.round("baseline", 2).alias("baseline_mean"),
        F.round(pct, 1).alias("drift_percentage"),
        alert.alias("alert"),
    )


def ingest_health(readings: DataFrame, as_of: Column, per_station: int = 2) -> DataFrame:
    """One row: rows and stations of the last hour against the expected rows."""
    recent = readings.filter((F.col("ts") > as_of - _hours(1)) & (F.col("ts") <= as_of))
    # counting per station first keeps the distinct count free of a second shuffle of raw rows
    counts = recent.groupBy("station").agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("last_hour_records"),
        F.count("*").alias("station_count"),
    )
    rows, expected = F.col("last_hour_records"), F.col("station_count") * per_station
    status = (
        F.when(rows == 0, "NO_DATA")
        .when(rows < expected * 0.5, "DEGRADED")
        .when(rows < expected, "PARTIAL")
        .otherwise("HEALTHY")
    )
    return counts.select(
        "last_hour_records", expected.alias("expected_records"), "station_count", status.alias("health_status")
    )


def monitoring_report(
    readings: DataFrame, stations: DataFrame, as_of: Column, hours: int = 24
) -> DataFrame:
    """Per station the quality and drift results as structs, plus the overall ingest health."""
    quality = recent_quality(readings, stations, as_of, hours)
    drift = sensor_drift(readings, stations, as_of)
    pack = lambda df, name: df.select(
        "station", F.struct(*[c for c in df.columns if c != "station"]).alias(name)
    )
    health = ingest_health(readings, as_of).select(F.struct("*").alias("h")).scalar()
    return pack(quality, "quality").join(pack(drift, "drift"), "station").withColumn("health", health)
