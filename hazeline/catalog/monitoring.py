"""Quality, stability and retrain queries over the test tables."""

from pyspark.sql import functions as F

from hazeline import tables
from hazeline.catalog import sql
from hazeline.catalog.models import ONE_INPUT, RUNS, registry_rounds
from hazeline.catalog.registry import query
from hazeline.catalog.series import hourly, log_pairs
from hazeline.operators import drift, features, quality
from hazeline.operators.training import score_models
from hazeline.session import stage_table

AS_OF = "2024-01-31 00:00:00"


def now():
    return F.lit(AS_OF).cast("timestamp_ntz")


# recent data

RECENT = f"""{sql.RAW}, {sql.STATIONS},
recent AS (SELECT * FROM raw WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '{AS_OF}'),
stats AS (
  SELECT station, count(*) AS n, count(pm25) AS present, avg(pm25) AS m, coalesce(stddev_samp(pm25), 0) AS s
  FROM recent GROUP BY station),
outs AS (
  SELECT station, count(*) AS o FROM recent JOIN stats USING (station) WHERE m <> 0 AND pm25 > m + 2 * s GROUP BY station),
quality AS (
  SELECT station, coalesce(n, 0) AS records_count, coalesce(1 - present / n, 1.0::DOUBLE) AS null_rate,
    coalesce(o, 0) AS outliers, CASE WHEN m <> 0 THEN round(m, 2) END AS mean_pm25, round(s, 2) AS std_pm25,
    CASE WHEN n IS NULL THEN 'NO_DATA' WHEN 1 - present / n > 0.5 THEN 'HIGH_NULL_RATE'
         WHEN coalesce(o, 0) > present * 0.1 THEN 'HIGH_OUTLIERS' WHEN m > 400 THEN 'EXTREME_VALUES' ELSE 'OK' END AS alert_level
  FROM stations LEFT JOIN stats USING (station) LEFT JOIN outs USING (station))"""

DRIFT = f"""means AS (
  SELECT station, avg(pm25) FILTER (ts > TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR) AS cur,
         avg(pm25) FILTER (ts <= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR) AS base
  FROM raw WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 169 HOUR AND ts <= TIMESTAMP '{AS_OF}' GROUP BY station),
pct AS (SELECT station, cur, base, CASE WHEN cur <> 0 AND base <> 0 THEN (cur - base) / base * 100 END AS p
        FROM stations LEFT JOIN means USING (station)),
drift AS (
  SELECT station, round(cur, 2) AS current_mean, round(base, 2) AS baseline_mean, round(p, 1) AS drift_percentage,
    CASE WHEN p IS NULL THEN 'INSUFFICIENT_DATA' WHEN abs(p) > 50 THEN 'SEVERE_DRIFT' WHEN abs(p) > 25 THEN 'MODERATE_DRIFT'
         ELSE 'OK' END AS alert FROM pct)"""


@query("m1_recent_quality", f"WITH {RECENT} SELECT * FROM quality")
def recent_quality(spark, sf_dir):
    stations = tables.event_stations(spark, sf_dir)
    return quality.recent_quality(tables.raw_readings(spark, sf_dir), stations, now())


@query("m2_sensor_drift", f"WITH {sql.RAW}, {sql.STATIONS}, {DRIFT} SELECT * FROM drift")
def sensor_drift(spark, sf_dir):
    stations = tables.event_stations(spark, sf_dir)
    return quality.sensor_drift(tables.raw_readings(spark, sf_dir), stations, now())


HEALTH = f"""health AS (
  SELECT count(*) AS last_hour_records, 2 * count(DISTINCT station) AS expected_records,
    count(DISTINCT station) AS station_count,
    CASE WHEN count(*) = 0 THEN 'NO_DATA' WHEN count(*) < count(DISTINCT station) THEN 'DEGRADED'
         WHEN count(*) < 2 * count(DISTINCT station) THEN 'PARTIAL' ELSE 'HEALTHY' END AS health_status
  FROM raw WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '{AS_OF}')"""


@query("m3_ingest_health", f"WITH {sql.RAW}, {HEALTH} SELECT * FROM health")
def ingest_health(spark, sf_dir):
    return quality.ingest_health(tables.raw_readings(spark, sf_dir), now())


@query(
    "m4_monitoring_report",
    f"""WITH {RECENT}, {DRIFT}, {HEALTH}
    SELECT station, records_count, alert_level, alert AS drift_alert, health_status
    FROM quality JOIN drift USING (station), health""",
)
def monitoring_report(spark, sf_dir):
    stations = tables.event_stations(spark, sf_dir)
    report = quality.monitoring_report(tables.raw_readings(spark, sf_dir), stations, now())
    return report.select(
        "station",
        "quality.records_count",
        "quality.alert_level",
        F.col("drift.alert").alias("drift_alert"),
        "health.health_status",
    )


# stability

TWO_SIDES = """samples AS (
  SELECT station, false AS is_actual, predicted AS value FROM pairs UNION ALL SELECT station, true, actual FROM pairs)"""


@query("m5_psi", f"WITH {sql.PAIRS}, {TWO_SIDES}, {sql.psi()} SELECT station, psi FROM psi_result")
def psi(spark, sf_dir):
    pairs = stage_table(log_pairs(spark, sf_dir), "pairs")
    return drift.psi(drift.wide_samples(pairs, "predicted", "actual"))


HALVES = sql.RAW + """,
samples AS (SELECT station, ts >= TIMESTAMP '2024-01-16' AS is_actual, pm25 AS value FROM raw)"""


def half_samples(spark, sf_dir):
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    rows = tables.raw_readings(spark, sf_dir)
    return rows.select("station", late.alias("is_actual"), F.col("pm25").alias("value"))


@query("m5_psi_raw_readings", f"WITH {HALVES}, {sql.psi()} SELECT station, psi FROM psi_result")
def psi_raw_readings(spark, sf_dir):
    return drift.psi(half_samples(spark, sf_dir))


@query(
    "m6_psi_equal_width",
    f"""WITH {HALVES}, spans AS (
      SELECT station, min(value) FILTER (NOT is_actual) AS lo, max(value) FILTER (NOT is_actual) AS hi,
             count(*) FILTER (NOT is_actual) AS ne, count(*) FILTER (is_actual) AS na FROM samples GROUP BY station),
    shares AS (
      SELECT station, ne, na, least(greatest(floor((value - lo) * 10 / (hi - lo)), 0), 9) AS bin,
             count(*) FILTER (NOT is_actual) AS ce, count(*) FILTER (is_actual) AS ca
      FROM samples JOIN spans USING (station) GROUP BY ALL),
    filled AS (
      SELECT station, CASE WHEN ce = 0 THEN 0.0001::DOUBLE ELSE ce / ne END AS pe,
             CASE WHEN ca = 0 THEN 0.0001::DOUBLE ELSE ca / na END AS pa FROM shares)
    SELECT station, round(sum((pa - pe) * ln(pa / pe)), 4) AS psi FROM filled GROUP BY station""",
)
def psi_equal_width(spark, sf_dir):
    return drift.psi_equal_width(half_samples(spark, sf_dir))


@query(
    "m7_feature_psi",
    f"""WITH {sql.HOURLY_WIDE}, samples AS (
      {" UNION ALL ".join(
          f"SELECT station, '{f}' AS feature, ts >= TIMESTAMP '2024-01-20' AS is_actual, CAST({f} AS DOUBLE) AS value FROM features"
          for f in features.HOURLY_FEATURES)}),
    {sql.psi(keys="station, feature")}
    SELECT station, feature, psi,
    CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS status FROM psi_result""",
)
def feature_psi(spark, sf_dir):
    wide = stage_table(features.build_hourly_features(hourly(spark, sf_dir)), "psi-features")
    recent = F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")
    return drift.feature_psi(wide.filter(~recent), wide.filter(recent), features.HOURLY_FEATURES)


# monitors

DAILY_STATIONS = "stations AS (SELECT DISTINCT o_orderpriority AS station FROM orders UNION ALL SELECT 'offline')"
DAILY_MONITOR = f"""{sql.PAIRS}, {DAILY_STATIONS},
recent AS (SELECT * FROM pairs QUALIFY date >= max(date) OVER (PARTITION BY station) - 30),
samples AS (
  SELECT station, false AS is_actual, predicted AS value FROM recent UNION ALL SELECT station, true, actual FROM recent),
{sql.psi()},
err AS (SELECT station, count(*) AS n, round(avg(abs(predicted - actual)), 4) AS mae FROM recent GROUP BY station),
joined AS (
  SELECT station, coalesce(n, 0) AS evaluated_pairs, CASE WHEN n >= 7 THEN mae END AS mae, CASE WHEN n >= 7 THEN psi END AS psi
  FROM stations LEFT JOIN err USING (station) LEFT JOIN psi_result USING (station)),
monitored AS (
  SELECT station, evaluated_pairs, mae, 6.0::DOUBLE AS mae_threshold, coalesce(mae > 6, false) AS mae_degraded, psi,
    0.2::DOUBLE AS psi_threshold,
    CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' WHEN psi IS NOT NULL THEN 'significant' END AS psi_status,
    coalesce(psi > 0.2, false) AS psi_degraded, coalesce(mae > 6, false) OR coalesce(psi > 0.2, false) AS needs_retraining
  FROM joined)"""


def daily_stations(spark, sf_dir):
    seen = tables.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("station"))
    return seen.distinct().unionByName(spark.createDataFrame([("offline",)], "station string"))


def monitored_days(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return drift.daily_monitor(*logs, ["entry"], daily_stations(spark, sf_dir))


@query("m8_daily_monitor", f"WITH {DAILY_MONITOR} SELECT * FROM monitored")
def daily_monitor(spark, sf_dir):
    return monitored_days(spark, sf_dir)


# the registry misses one station, one model has no file and one expects other features
REGISTRY = """registry AS (
  SELECT station, 'lag24_' || station AS model_key, '2024-01-10' AS train_end, station <> 'error' AS has_file,
         CASE WHEN station = 'signup' THEN 17 ELSE 19 END AS n_features
  FROM stations WHERE station <> 'view')"""

FORECAST_MONITOR = f"""late AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-12'),
{sql.HOURLY_WIDE.replace("FROM events", "FROM late")},
{sql.STATIONS}, {REGISTRY},
hours_seen AS (SELECT station, count(*) AS n_hours FROM series GROUP BY station),
recent AS (
  SELECT station, pm25_lag_24 AS predicted, pm25_h24 AS actual FROM features
  QUALIFY ts >= max(ts) OVER (PARTITION BY station) - INTERVAL 14 DAY),
{sql.metrics("recent", "station")},
samples AS (
  SELECT station, false AS is_actual, predicted AS value FROM recent UNION ALL SELECT station, true, actual FROM recent),
{sql.psi()},
judged AS (
  SELECT station, model_key, train_end, n, m.rmse, m.mae, p.psi,
    CASE WHEN model_key IS NULL THEN 'no_model' WHEN NOT has_file THEN 'missing_onnx'
         WHEN coalesce(n_hours, 0) < 192 THEN 'insufficient_data' WHEN coalesce(n, 0) < 168 THEN 'insufficient_window'
         WHEN n_features <> 19 THEN 'shape_mismatch' WHEN m.rmse > 13 OR p.psi > 0.2 THEN 'degraded' ELSE 'healthy' END AS status
  FROM stations LEFT JOIN registry USING (station) LEFT JOIN hours_seen USING (station)
  LEFT JOIN metrics m USING (station) LEFT JOIN psi_result p USING (station)),
shown AS (
  SELECT *, status IN ('healthy', 'degraded') AS ok FROM judged),
monitored AS (
  SELECT station, status, status IN ('degraded', 'missing_onnx', 'shape_mismatch') AS needs_retraining,
    CASE WHEN ok THEN rmse END AS rmse, 13.0::DOUBLE AS rmse_threshold, CASE WHEN ok THEN rmse > 13 END AS rmse_degraded,
    CASE WHEN ok THEN mae END AS mae, CASE WHEN ok THEN psi END AS psi, 0.2::DOUBLE AS psi_threshold,
    CASE WHEN ok THEN CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END END AS psi_status,
    CASE WHEN ok THEN psi > 0.2 END AS psi_degraded, CASE WHEN ok THEN n END AS evaluated_pairs, model_key, train_end
  FROM shown)"""


def model_registry(stations):
    name = F.col("station")
    return stations.filter(name != "view").select(
        "station",
        F.concat(F.lit("lag24_"), "station").alias("model_key"),
        F.lit("2024-01-10").alias("train_end"),
        (name != "error").alias("has_file"),
        F.when(name == "signup", 17).otherwise(19).alias("n_features"),
    )


def monitored_forecasts(spark, sf_dir, since="2024-01-12", as_of=AS_OF):
    stations = tables.event_stations(spark, sf_dir)
    return drift.forecast_monitor(
        tables.hourly_readings(spark, sf_dir, since=since, until=as_of),
        model_registry(stations),
        stations,
        as_of,
        lambda df: df.withColumn("predicted", F.col("pm25_lag_24")),
    )


@query("m9_forecast_monitor", f"WITH {FORECAST_MONITOR} SELECT * FROM monitored")
def forecast_monitor(spark, sf_dir):
    return monitored_forecasts(spark, sf_dir)


M9_TWIN = FORECAST_MONITOR.replace(f"{REGISTRY},", "registry AS (SELECT station, model_key, train_end, true AS has_file, 19 AS n_features FROM trained),").replace(
    "pm25_lag_24 AS predicted, pm25_h24 AS actual FROM features",
    "intercept + slope * pm25_lag_1 AS predicted, pm25_h24 AS actual FROM features JOIN trained USING (station)",
)


@query(
    "m9_from_registry",
    f"WITH trained AS (WITH {RUNS} SELECT * FROM active), {M9_TWIN} SELECT * FROM monitored",
)
def monitor_from_registry(spark, sf_dir):
    """The monitor scores what the training runs stored: the registry's weights, joined by station."""
    _, active = registry_rounds(spark, sf_dir)
    active, stations = stage_table(active, "active-models"), tables.event_stations(spark, sf_dir)
    registry = active.select(
        "station", "model_key", F.col("train_end").cast("string").alias("train_end"), F.lit(True).alias("has_file"), "n_features"
    )
    return drift.forecast_monitor(
        tables.hourly_readings(spark, sf_dir, since="2024-01-12", until=AS_OF), registry, stations, AS_OF,
        lambda df: score_models(df, active, ONE_INPUT, ["station", "pm25_h24"], ["linear"]), inputs=ONE_INPUT,
    )


BACKFILL = FORECAST_MONITOR.replace(
    "ts >= TIMESTAMP '2024-01-12'", "ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-01-28'"
)


@query("m9_backfilled_monitor", f"WITH {BACKFILL} SELECT * FROM monitored")
def backfilled_monitor(spark, sf_dir):
    """The monitor as of a day inside the data sees nothing later."""
    return monitored_forecasts(spark, sf_dir, "2024-01-09", "2024-01-28")


@query(
    "m10_retrain_candidates",
    f"""WITH {DAILY_MONITOR} SELECT station, array_to_string(list_filter([
      CASE WHEN mae_degraded THEN 'MAE ' || printf('%.4f', mae) || ' > 6.0' END,
      CASE WHEN psi_degraded THEN 'PSI ' || printf('%.4f', psi) || ' > 0.2' END], lambda x: x IS NOT NULL), ', ') AS reasons
    FROM monitored WHERE needs_retraining""",
)
def retrain_candidates(spark, sf_dir):
    return drift.retrain_candidates(monitored_days(spark, sf_dir), "mae")


@query(
    "m11_monitor_summary",
    f"""WITH {FORECAST_MONITOR} SELECT station, upper(status) AS status, coalesce(printf('%.4f', rmse), 'N/A') AS rmse,
    coalesce(printf('%.4f', mae), 'N/A') AS mae, coalesce(printf('%.4f', psi), 'N/A') AS psi, coalesce(model_key, 'N/A') AS model
    FROM monitored""",
)
def monitor_summary(spark, sf_dir):
    return drift.monitor_summary(monitored_forecasts(spark, sf_dir), tables.event_stations(spark, sf_dir))


@query(
    "m12_retrain_decision",
    f"""WITH {sql.PAIRS}, d AS (SELECT station, count(*) AS n, avg(abs(actual - predicted)) AS mae FROM pairs GROUP BY station)
    SELECT station, n AS evaluated_pairs, CASE WHEN n >= 7 THEN round(mae, 4) END AS mae, 6.0::DOUBLE AS threshold,
    n >= 7 AND mae > 6 AS retrain_triggered,
    CASE WHEN n < 7 THEN 'not_enough_pairs' WHEN mae > 6 THEN 'mae_above_threshold' ELSE 'healthy' END AS reason FROM d""",
)
def retrain_decision(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return drift.retrain_decision(*logs, ["entry"])


@query(
    "m13_monitoring_trend",
    f"""WITH {sql.PAIRS}, samples AS (
      SELECT station, date_trunc('year', date) AS m, false AS is_actual, predicted AS value FROM pairs UNION ALL
      SELECT station, date_trunc('year', date), true, actual FROM pairs),
    {sql.psi(keys="station, m")},
    err AS (SELECT station, date_trunc('year', date) AS m, round(avg(abs(predicted - actual)), 2) AS mae FROM pairs GROUP BY ALL)
    SELECT station, CAST(CAST(m AS DATE) AS VARCHAR) AS checked_at, mae, 6.0::DOUBLE AS mae_threshold, psi,
    CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'moderate' ELSE 'significant' END AS psi_status,
    mae > 6 OR psi > 0.2 AS retrain_event FROM err JOIN psi_result USING (station, m)""",
)
def monitoring_trend(spark, sf_dir):
    pairs = log_pairs(spark, sf_dir).withColumn("checked_at", F.trunc("date", "year"))
    keys = ["station", "checked_at"]
    error = F.abs(F.col("predicted") - F.col("actual"))
    mae = pairs.groupBy(*keys).agg(F.round(F.avg(error), 2).alias("mae"))
    index = drift.window_health(pairs, keys).select(*keys, "psi")  # one year of days per group
    return drift.monitoring_trend(mae.join(index, keys))
