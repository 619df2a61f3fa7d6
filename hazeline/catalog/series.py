"""Gap filling, window features and aggregates over the test tables."""

from pyspark.sql import functions as F

from hazeline import tables
from hazeline.catalog import sql
from hazeline.catalog.readings import SLOTS, hour_rows
from hazeline.catalog.registry import query
from hazeline.functions.scalar import BANDS, STRICT_LADDER
from hazeline.operators import aggregate, features, gaps, pairs, ranges
from hazeline.operators.upsert import dedupe_first
from hazeline.operators.validate import drop_incomplete
from hazeline.plans.series import over_chunks, positioned
from hazeline.session import stage_table

DAY = "CAST(date AS VARCHAR) AS date"
AT = "CAST(ts AS VARCHAR) AS ts"


def hourly(spark, sf_dir):
    return gaps.hourly_series(tables.hourly_readings(spark, sf_dir))


# gap filling

FORWARD = """last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
BACKWARD = """first_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@query(
    "g1_forward_back_fill",
    f"WITH {sql.GAPPY} SELECT station, {DAY}, round(coalesce({FORWARD}, {BACKWARD}), 6) AS pm25 FROM gappy",
)
def forward_back_fill(spark, sf_dir):
    return gaps.fill_series(tables.gappy_readings(spark, sf_dir), "ffill")


@query(
    "g2_interpolate",
    f"""WITH {sql.GAPPY}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY station ORDER BY date) AS rn,
             CASE WHEN pm25 IS NOT NULL THEN row_number() OVER (PARTITION BY station ORDER BY date) END AS seen
      FROM gappy),
    placed AS (
      SELECT *, {FORWARD} AS pv, {BACKWARD} AS nv,
        max(seen) OVER (PARTITION BY station ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
        min(seen) OVER (PARTITION BY station ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
      FROM numbered)
    SELECT station, {DAY}, round(CASE WHEN pm25 IS NOT NULL THEN pm25 WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
      ELSE pv + (nv - pv) * (rn - pp) / (np - pp) END, 6) AS pm25 FROM placed""",
)
def interpolate(spark, sf_dir):
    return gaps.fill_series(tables.gappy_readings(spark, sf_dir), "interpolate")


@query(
    "g3_drop_missing",
    f"WITH {sql.GAPPY} SELECT station, {DAY}, round(pm25, 6) AS pm25 FROM gappy WHERE pm25 IS NOT NULL",
)
def drop_missing(spark, sf_dir):
    return gaps.fill_series(tables.gappy_readings(spark, sf_dir), "drop")


@query(
    "g4_fill_flagged",
    f"""WITH {sql.GAPPY}, filled AS (SELECT station, date, pm25 AS observed, {FORWARD} AS pm25 FROM gappy)
    SELECT station, {DAY}, round(pm25, 6) AS pm25, round(observed, 6) AS pm25_observed,
    observed IS NULL AND pm25 IS NOT NULL AS was_filled FROM filled""",
)
def fill_flagged(spark, sf_dir):
    return gaps.fill_flagged(tables.gappy_readings(spark, sf_dir))


@query(
    "g5_fill_limited",
    f"""WITH {sql.GAPPY} SELECT station, {DAY}, round(coalesce(
      last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW),
      first_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)), 6) AS pm25
    FROM gappy""",
)
def fill_limited(spark, sf_dir):
    return gaps.fill_limited(tables.gappy_readings(spark, sf_dir), 1)


@query(
    "g6_preprocess",
    f"""WITH {sql.GAPPY}, filled AS (SELECT station, date, coalesce({FORWARD}, {BACKWARD}) AS pm25 FROM gappy)
    SELECT station, {DAY}, round(pm25, 6) AS pm25 FROM filled WHERE pm25 BETWEEN 0 AND 450""",
)
def preprocess(spark, sf_dir):
    return gaps.preprocess(tables.gappy_readings(spark, sf_dir), bounds=(0.0, 450.0))


@query(
    "g7_missing_report",
    f"""WITH {sql.GAPPY}, f AS (
      SELECT station, pm25, last_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date
        ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS back,
        first_value(pm25 IGNORE NULLS) OVER (PARTITION BY station ORDER BY date
        ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS ahead FROM gappy)
    SELECT station, count(*) FILTER (pm25 IS NULL) AS missing_before,
    count(*) FILTER (back IS NULL AND ahead IS NULL) AS missing_after FROM f GROUP BY station""",
)
def missing_report(spark, sf_dir):
    before = tables.gappy_readings(spark, sf_dir)
    return gaps.missing_report(before, gaps.fill_limited(before, 1))


# window features


def daily_windows(spark, sf_dir, columns, back, ahead=0):
    numbered = positioned(tables.daily_readings(spark, sf_dir), "date", pos="pos")
    return over_chunks(numbered, columns, "pos", back, ahead).drop("pos")


def _rounded(names):
    return ", ".join(f'round("{n}", 6) AS "{n}"' for n in names)


LAGS = [f"pm25_lag_{n}" for n in sql.DAILY_LAGS]
OVER_DAYS = "PARTITION BY station ORDER BY date"


@query(
    "w1_lags",
    f"""WITH {sql.DAILY}, l AS (SELECT station, date, {sql.lags(sql.DAILY_LAGS)} FROM daily
    WINDOW w AS ({OVER_DAYS})) SELECT station, {DAY}, {_rounded(LAGS)} FROM l""",
)
def lags(spark, sf_dir):
    wide = daily_windows(spark, sf_dir, lambda w: features.lag_columns(w, features.DAILY_LAGS), 7)
    return wide.drop("pm25")


def _rolling_names(windows, stats=("mean", "std"), suffix=""):
    return [f"pm25_rolling_{s}_{n}{suffix}" for n in windows for s in stats]


ROLLED = f"r AS (SELECT station, date, {sql.rolling((3, 7, 14), 1, part=OVER_DAYS)} FROM daily)"


@query(
    "w2_rolling_mean",
    f"WITH {sql.DAILY}, {ROLLED} SELECT station, {DAY}, {_rounded(_rolling_names((3, 7, 14), ['mean']))} FROM r",
)
def rolling_mean(spark, sf_dir):
    columns = lambda w: features.rolling_columns(w, (3, 7, 14), min_rows=1)
    wide = daily_windows(spark, sf_dir, columns, 14)
    return wide.select("station", "date", *_rolling_names((3, 7, 14), ["mean"]))


@query(
    "w3_rolling_std",
    f"WITH {sql.DAILY}, {ROLLED} SELECT station, {DAY}, {_rounded(_rolling_names((3, 7, 14), ['std']))} FROM r",
)
def rolling_std(spark, sf_dir):
    columns = lambda w: features.rolling_columns(w, (3, 7, 14), min_rows=1)
    wide = daily_windows(spark, sf_dir, columns, 14)
    return wide.select("station", "date", *_rolling_names((3, 7, 14), ["std"]))


@query(
    "w4_full_windows",
    f"""WITH {sql.SERIES}, r AS (SELECT station, ts, {sql.rolling((6, 12, 24), suffix="h")} FROM series)
    SELECT station, {AT}, {_rounded(_rolling_names((6, 12, 24), suffix="h"))} FROM r""",
)
def full_windows(spark, sf_dir):
    columns = lambda w: features.rolling_columns(w, (6, 12, 24), suffix="h")
    wide = over_chunks(hourly(spark, sf_dir), columns, "hour", back=24)
    return wide.drop("hour", "pm25", "observed")


@query(
    "w5_diffs",
    f"""WITH {sql.SERIES} SELECT station, {AT}, round(lag(pm25, 1) OVER w - lag(pm25, 2) OVER w, 6) AS diff_1h,
    round(lag(pm25, 1) OVER w - lag(pm25, 25) OVER w, 6) AS diff_24h
    FROM series WINDOW w AS (PARTITION BY station ORDER BY ts)""",
)
def diffs(spark, sf_dir):
    columns = lambda w: {
        "diff_1h": features.lagged_diff(w, 1),
        "diff_24h": features.lagged_diff(w, 24),
    }
    wide = over_chunks(hourly(spark, sf_dir), columns, "hour", back=25)
    return wide.select("station", "ts", "diff_1h", "diff_24h")


@query(
    "w6_pct_change",
    f"""WITH {sql.DAILY} SELECT station, {DAY}, round(lag(pm25, 1) OVER w / lag(pm25, 2) OVER w - 1, 6) AS pct_change
    FROM daily WINDOW w AS ({OVER_DAYS})""",
)
def pct_change(spark, sf_dir):
    columns = lambda w: {"pct_change": features.lagged_pct_change(w)}
    return daily_windows(spark, sf_dir, columns, 2).drop("pm25")


@query("w7_calendar", f"SELECT event_id, {sql.calendar('ts', hourly=True)} FROM events")
def calendar(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("event_id", "ts")
    return events.withColumns(features.calendar_columns(F.col("ts"), hourly=True)).drop("ts")


@query(
    "w8_lead_target",
    f"""WITH {sql.SERIES} SELECT station, {AT}, lead(pm25, 24) OVER (PARTITION BY station ORDER BY ts) AS pm25_h24
    FROM series""",
)
def lead_target(spark, sf_dir):
    columns = lambda w: {"pm25_h24": features.lead_target(w)}
    wide = over_chunks(hourly(spark, sf_dir), columns, "hour", ahead=24)
    return wide.select("station", "ts", "pm25_h24")


CALENDAR = ["day_of_week", "month", "day_of_year", "is_weekend"]
DAILY_OUT = f"""station, {DAY}, round(pm25, 6) AS pm25, {_rounded(LAGS + _rolling_names((3, 7, 14)))},
    {", ".join(CALENDAR)}, {_rounded(["pm25_diff_1", "pm25_pct_change_1"])}"""


@query(
    "w9_daily_features",
    f"WITH {sql.DAILY}, {sql.daily_features()} SELECT {DAILY_OUT} FROM features",
)
def daily_features(spark, sf_dir):
    return features.build_daily_features(tables.daily_readings(spark, sf_dir))


@query(
    "w9_serving_features",
    f"""WITH {sql.DAILY}, {sql.daily_features(min_rows=None, keep="pm25_rolling_std_14 IS NOT NULL")}
    SELECT {DAILY_OUT} FROM features""",
)
def serving_features(spark, sf_dir):
    return features.build_daily_features(tables.daily_readings(spark, sf_dir), min_rows=None)


HOURLY_OUT = f"""station, {AT}, round(pm25, 6) AS pm25,
    {_rounded([f"pm25_lag_{n}" for n in sql.HOURLY_LAGS] + _rolling_names((6, 12, 24), suffix="h"))},
    {_rounded(["pm25_diff_1h", "pm25_diff_24h"])}, hour, {", ".join(CALENDAR)}, round(pm25_h24, 6) AS pm25_h24"""


@query("w10_hourly_features", f"WITH {sql.HOURLY_WIDE} SELECT {HOURLY_OUT} FROM features")
def hourly_features(spark, sf_dir):
    return features.build_hourly_features(hourly(spark, sf_dir))


@query(
    "w10_many_series",
    "WITH " + sql.HOURLY_WIDE.replace("event_type AS station", "user_id AS station") + f" SELECT {HOURLY_OUT} FROM features",
)
def many_series(spark, sf_dir):
    series = gaps.hourly_series(tables.hourly_readings(spark, sf_dir, "user_id"))
    return features.build_hourly_features(series)


@query(
    "w11_guide_features",
    f"""WITH {sql.DAILY}, g AS (
      SELECT station, date, pm25, pm25 AS pm25_lag_1, {", ".join(f"lag(pm25, {n - 1}) OVER w AS pm25_lag_{n}" for n in (2, 3, 5, 7))},
      {", ".join(
          f"CASE WHEN count(pm25) OVER f{n} >= {n} THEN {fn}(pm25) OVER f{n} END AS pm25_rolling_{name}_{n}"
          for n in (3, 7) for name, fn in (("mean", "avg"), ("std", "stddev_samp")))}
      FROM daily WINDOW w AS ({OVER_DAYS}), f3 AS ({OVER_DAYS} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
        f7 AS ({OVER_DAYS} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT station, {DAY}, round(pm25, 6) AS pm25, {_rounded(LAGS + _rolling_names((3, 7)))}, {sql.calendar("date")},
    CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(week(date) AS INTEGER) AS week_of_year, CAST(day(date) AS INTEGER) AS day_of_month
    FROM g WHERE pm25_lag_7 IS NOT NULL""",
)
def guide_features(spark, sf_dir):
    return features.build_guide_features(tables.daily_readings(spark, sf_dir))


@query(
    "w12_feature_columns",
    f"""WITH {sql.HOURLY_WIDE} SELECT feature, CAST(position AS INTEGER) AS position, (SELECT count(*) FROM features) AS present
    FROM (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(features.HOURLY_FEATURES))}) v(position, feature)""",
)
def feature_columns(spark, sf_dir):
    wide = features.build_hourly_features(hourly(spark, sf_dir))
    names = features.feature_columns(wide)
    counts = wide.agg(*[F.count(n).alias(n) for n in names])
    listed = counts.unpivot([], names, "feature", "present")
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("feature"))
    return listed.withColumn("position", (position - 1).cast("int"))


@query(
    "w13_trailing_window",
    f"""WITH {sql.SERIES} SELECT station, {AT}, pm25 FROM series
    QUALIFY ts >= max(ts) OVER (PARTITION BY station) - INTERVAL 14 DAY""",
)
def trailing_window(spark, sf_dir):
    return features.trailing_window(hourly(spark, sf_dir), 14).select("station", "ts", "pm25")


@query(
    "w14_latest",
    f"""WITH {sql.HOURLY} SELECT station, {AT}, pm25, CAST(row_number() OVER w AS INTEGER) AS recency
    FROM readings WINDOW w AS (PARTITION BY station ORDER BY ts DESC) QUALIFY row_number() OVER w <= 7""",
)
def latest(spark, sf_dir):
    return features.latest(tables.hourly_readings(spark, sf_dir), 7)


@query(
    "w15_latest_report",
    f"WITH {sql.HOURLY} SELECT station, {AT}, pm25 FROM readings QUALIFY row_number() OVER (PARTITION BY station ORDER BY ts DESC) = 1",
)
def latest_report(spark, sf_dir):
    return features.latest_report(tables.hourly_readings(spark, sf_dir), "ts")


@query(
    "w16_thin",
    f"""WITH {sql.HOURLY} SELECT station, {AT}, pm25 FROM readings
    QUALIFY (row_number() OVER (PARTITION BY station ORDER BY ts) - 1) % 4 = 0""",
)
def thin(spark, sf_dir):
    return features.thin(tables.hourly_readings(spark, sf_dir), 4)


# aggregates


@query(
    "a1_daily_mean",
    f"""WITH {sql.HOURLY} SELECT station, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(avg(pm25), 6) AS pm25
    FROM readings GROUP BY ALL""",
)
def daily_mean(spark, sf_dir):
    return aggregate.daily_mean(tables.hourly_readings(spark, sf_dir))


@query(
    "a2_daily_local_mean",
    f"""WITH {sql.HOURLY}, local AS (SELECT station, CAST(ts + INTERVAL 7 HOUR AS DATE) AS date, pm25 FROM readings)
    SELECT station, {DAY}, CAST(round(CAST(avg(pm25) AS DECIMAL(38,12)), 2) AS DOUBLE) AS pm25, count(pm25) AS hourly_points
    FROM local WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' GROUP BY ALL""",
)
def daily_local_mean(spark, sf_dir):
    readings = tables.hourly_readings(spark, sf_dir, since="2024-01-02 17:00:00", until="2024-01-25 17:00:00")
    return aggregate.daily_local_mean(readings, "2024-01-03", "2024-01-25")


@query("a3_row_count", 'SELECT count(*) AS "rows" FROM events WHERE event_type = \'click\'')
def row_count(spark, sf_dir):
    return aggregate.row_count(tables.raw_readings(spark, sf_dir), "click")


@query(
    "a4_coverage",
    f"""WITH {sql.HOURLY} SELECT station, count(*) AS "rows", round(count(*) / 24, 6) AS days,
    CAST(min(ts) AS VARCHAR) AS "first", CAST(max(ts) AS VARCHAR) AS "last" FROM readings GROUP BY station""",
)
def coverage(spark, sf_dir):
    return aggregate.coverage(tables.hourly_readings(spark, sf_dir))


def log_pairs(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return pairs.pair_predictions(*logs, ["entry"])


@query("a5_regression_metrics", f"WITH {sql.PAIRS}, {sql.metrics('pairs', 'station')} SELECT * FROM metrics")
def regression_metrics(spark, sf_dir):
    return aggregate.regression_metrics(log_pairs(spark, sf_dir))


@query(
    "a6_mape",
    f"""WITH {sql.PAIRS} SELECT station, round(100 * avg(abs(actual - predicted) / actual) FILTER (actual > 0), 6) AS mape
    FROM pairs GROUP BY station""",
)
def mape(spark, sf_dir):
    return aggregate.mape(log_pairs(spark, sf_dir))


@query(
    "a7_bias",
    f"WITH {sql.PAIRS} SELECT station, round(avg(predicted - actual), 6) AS bias, count(*) AS pairs FROM pairs GROUP BY station",
)
def bias(spark, sf_dir):
    return aggregate.bias(log_pairs(spark, sf_dir))


@query(
    "a7_bias_of_raw_pairs",
    f"""WITH {sql.LOGS} SELECT p.station, count(*) AS pairs, round(avg(predicted - actual), 6) AS bias
    FROM predictions p JOIN actuals a ON p.station = a.station AND p.date = a.date GROUP BY p.station""",
)
def bias_of_raw_pairs(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return aggregate.bias_of_raw_pairs(pairs.pair_raw(*logs))


@query(
    "a8_metrics_by_regime",
    f"""WITH {sql.PAIRS}, banded AS (
      SELECT *, CASE WHEN actual < 35 THEN 'low' WHEN actual <= 75 THEN 'moderate' ELSE 'high' END AS regime FROM pairs),
    {sql.metrics("banded", "station, regime", 6)},
    tail AS (SELECT station, regime, quantile_cont(abs(actual - predicted), 0.95) AS p95 FROM banded GROUP BY ALL)
    SELECT m.*, round(p95, 6) AS p95_error FROM metrics m JOIN tail t USING (station, regime)""",
)
def metrics_by_regime(spark, sf_dir):
    pairs_once = stage_table(log_pairs(spark, sf_dir), "pairs")
    return aggregate.metrics_by_regime(pairs_once, places=6)


@query(
    "a9_describe",
    """SELECT event_type AS station, count(value) AS "count", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
    min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS p25,
    round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75
    FROM events GROUP BY event_type""",
)
def describe(spark, sf_dir):
    return aggregate.describe_by_station(tables.raw_readings(spark, sf_dir))


@query(
    "a10_histogram",
    f"""WITH {sql.RAW}, spans AS (SELECT station, min(pm25) AS lo, max(pm25) AS hi FROM raw GROUP BY station),
    slots AS (SELECT station, lo, hi, CAST(unnest(range(30)) AS INTEGER) AS bin FROM spans),
    placed AS (
      SELECT station, CAST(least(floor((pm25 - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n
      FROM raw JOIN spans USING (station) GROUP BY ALL)
    SELECT s.station, s.bin, round(lo + s.bin * ((hi - lo) / 30), 6) AS left_edge, coalesce(n, 0) AS "count"
    FROM slots s LEFT JOIN placed p ON p.station = s.station AND p.bin = s.bin""",
)
def histogram(spark, sf_dir):
    return aggregate.histogram(tables.raw_readings(spark, sf_dir), 30)


@query(
    "a11_box_by_month",
    f"""WITH {sql.DAILY}, monthly AS (SELECT station, CAST(month(date) AS INTEGER) AS month, pm25 FROM daily),
    box AS (
      SELECT station, month, quantile_cont(pm25, 0.25) AS q1, quantile_cont(pm25, 0.5) AS median, quantile_cont(pm25, 0.75) AS q3
      FROM monthly GROUP BY ALL),
    fenced AS (
      SELECT *, pm25 BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM monthly JOIN box USING (station, month))
    SELECT station, month, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    round(min(pm25) FILTER (inside), 6) AS whisker_low, round(max(pm25) FILTER (inside), 6) AS whisker_high,
    count(*) FILTER (NOT inside) AS outliers FROM fenced GROUP BY station, month, q1, median, q3""",
)
def box_by_month(spark, sf_dir):
    return aggregate.box_by_month(stage_table(tables.daily_readings(spark, sf_dir), "daily"))


@query(
    "a12_season_stats",
    f"""WITH {sql.DAILY} SELECT station, CASE WHEN month(date) IN (1, 2, 3, 4, 11, 12) THEN 'dry' ELSE 'wet' END AS season,
    round(avg(pm25), 6) AS mean, round(stddev_samp(pm25), 6) AS std, count(pm25) AS days FROM daily GROUP BY ALL""",
)
def season_stats(spark, sf_dir):
    return aggregate.season_stats(tables.daily_readings(spark, sf_dir))


CORRELATED = ["pm25", *[f"pm25_lag_{n}" for n in features.CORRELATION_LAGS]]


@query(
    "a13_lag_correlation",
    f"""WITH {sql.DAILY}, l AS (
      SELECT station, pm25, {sql.lags(features.CORRELATION_LAGS)} FROM daily WINDOW w AS ({OVER_DAYS}) QUALIFY pm25_lag_14 IS NOT NULL)
    """
    + " UNION ALL ".join(
        f"""SELECT station, '{a}' AS "left", '{b}' AS "right", round(corr({a}, {b}), 6) AS r FROM l GROUP BY station"""
        for i, a in enumerate(CORRELATED)
        for b in CORRELATED[i + 1 :]
    ),
)
def lag_correlation(spark, sf_dir):
    return aggregate.lag_correlation(tables.daily_readings(spark, sf_dir))


@query(
    "a14_missing_pct",
    f"""WITH {sql.DAILY}, days AS (SELECT DISTINCT date FROM daily), names AS (SELECT DISTINCT station FROM daily),
    m AS (
      SELECT n.station, 100 * avg(CASE WHEN pm25 IS NULL THEN 1.0 ELSE 0.0 END) AS pct
      FROM days d JOIN names n ON true LEFT JOIN daily v ON v.date = d.date AND v.station = n.station GROUP BY ALL)
    SELECT station, round(pct, 6) AS missing_pct, pct > 10 AS above_10, pct < 2 AS below_2 FROM m""",
)
def missing_pct(spark, sf_dir):
    from hazeline.sources.sheets import unpivot_stations

    return aggregate.missing_pct(unpivot_stations(tables.wide_sheet(spark, sf_dir)))


_BAND = " ".join(f"WHEN m <= {b} THEN '{n}'" for b, n in zip(STRICT_LADDER, BANDS))


@query(
    "a15_forecast_summary",
    f"""WITH {sql.HOURLY}, last AS (
      SELECT station, pm25 AS predicted FROM readings QUALIFY row_number() OVER (PARTITION BY station ORDER BY ts DESC) = 1),
    s AS (SELECT count(*) AS stations, avg(predicted) AS m, max(predicted) AS highest, min(predicted) AS lowest FROM last)
    SELECT stations, round(m, 6) AS mean_forecast, highest,
    (SELECT station FROM last ORDER BY predicted DESC, station LIMIT 1) AS highest_station, lowest,
    (SELECT station FROM last ORDER BY predicted, station LIMIT 1) AS lowest_station,
    CASE {_BAND} ELSE '{BANDS[-1]}' END AS band FROM s""",
)
def forecast_summary(spark, sf_dir):
    last = features.latest_report(tables.hourly_readings(spark, sf_dir), "ts")
    return aggregate.forecast_summary(last.withColumnRenamed("pm25", "predicted"))


@query(
    "a16_pair_stats",
    f"""WITH {sql.PAIRS} SELECT station, count(*) AS pairs, CAST(min(date) AS VARCHAR) AS "first", CAST(max(date) AS VARCHAR) AS "last",
    round(avg(predicted), 6) AS predicted_mean, round(stddev_samp(predicted), 6) AS predicted_std,
    round(avg(actual), 6) AS actual_mean, round(stddev_samp(actual), 6) AS actual_std FROM pairs GROUP BY station""",
)
def pair_stats(spark, sf_dir):
    return aggregate.pair_stats(log_pairs(spark, sf_dir))


@query(
    "a18_hourly_missing_rate",
    f"""WITH {sql.GRID} SELECT {AT}, count(*) AS stations, round(avg(CASE WHEN pm25 IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate
    FROM grid GROUP BY ts""",
)
def hourly_missing_rate(spark, sf_dir):
    return aggregate.hourly_missing_rate(gaps.hourly_grid(tables.hourly_readings(spark, sf_dir)))


@query(
    "a18_anomaly_count",
    "SELECT event_type AS station, count(*) FILTER (value < 0 OR value > 200) AS anomalies FROM events GROUP BY event_type",
)
def anomaly_count(spark, sf_dir):
    return aggregate.anomaly_count(tables.raw_readings(spark, sf_dir), 0, 200)


# sorting and ranges


@query("o1_sort_series", f"WITH {sql.HOURLY} SELECT station, {AT}, pm25 FROM readings ORDER BY station, ts")
def sort_series(spark, sf_dir):
    return ranges.sort_series(tables.hourly_readings(spark, sf_dir))


@query(
    "o3_date_chunks",
    """WITH span AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS hi FROM orders),
    starts AS (SELECT hi, unnest(generate_series(lo, hi, INTERVAL 30 DAY)) AS s FROM span)
    SELECT CAST(row_number() OVER (ORDER BY s) - 1 AS INTEGER) AS chunk, CAST(s AS VARCHAR) AS chunk_start,
    CAST(least(s + INTERVAL 30 DAY - INTERVAL 1 SECOND, hi) AS VARCHAR) AS chunk_end FROM starts""",
)
def date_chunks(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders")
    day_end = F.make_dt_interval(hours=F.lit(23), mins=F.lit(59), secs=F.lit(59))
    span = orders.agg(F.min("o_orderdate").alias("start"), (F.max("o_orderdate") + day_end).alias("end"))
    return ranges.date_chunks(span)


@query(
    "w16_thin_raw_hours",
    f"""WITH {SLOTS}, uniq AS (SELECT * FROM slots QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1)
    SELECT event_id FROM uniq QUALIFY (row_number() OVER (PARTITION BY station ORDER BY ts) - 1) % 6 = 0""",
)
def thin_raw_hours(spark, sf_dir):
    rows = dedupe_first(hour_rows(spark, sf_dir), ["station", "ts"], ["event_id"])
    return features.thin(drop_incomplete(rows), 6).select("event_id")
