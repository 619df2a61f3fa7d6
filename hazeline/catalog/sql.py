"""SQL fragments shared by the DuckDB twins. Each is a list of CTEs without the WITH."""

HOURLY = """readings AS (
  SELECT event_type AS station, date_trunc('hour', ts) AS ts, max(value) AS pm25
  FROM events GROUP BY ALL)"""

RAW = """raw AS (
  SELECT event_id, event_type AS station, ts, value AS pm25,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS pm10
  FROM events)"""

GRID = HOURLY + """,
span AS (SELECT station, min(ts) AS lo, max(ts) AS hi FROM readings GROUP BY station),
hours AS (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM span),
grid AS (SELECT h.station, h.ts, r.pm25 FROM hours h LEFT JOIN readings r
         ON h.station = r.station AND h.ts = r.ts)"""

SERIES = GRID + """,
series AS (
  SELECT station, ts, least(greatest(last_value(pm25 IGNORE NULLS) OVER (
    PARTITION BY station ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0), 500.0) AS pm25
  FROM grid)"""

DAILY = """daily AS (
  SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) AS date, max(floor(o_totalprice) / 1000) AS pm25
  FROM orders GROUP BY ALL)"""

GAPPY = """gappy AS (
  SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) AS date,
         max(CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice) / 1000 END) AS pm25
  FROM orders GROUP BY ALL)"""

LOGS = """predictions AS (
  SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) + 1 AS date,
         floor(o_totalprice) / 1000 AS predicted, o_orderkey AS entry FROM orders),
actuals AS (
  SELECT o_orderpriority AS station, CAST(o_orderdate AS DATE) AS date,
         floor(o_totalprice) / 1000 AS actual, o_orderkey AS entry FROM orders)"""

PAIRS = LOGS + """,
pairs AS (
  SELECT p.station, p.date, p.predicted, a.actual
  FROM (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry DESC) = 1) p
  JOIN (SELECT * FROM actuals QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry DESC) = 1) a
    ON p.station = a.station AND p.date = a.date)"""

STATIONS = """stations AS (
  SELECT DISTINCT event_type AS station FROM events UNION ALL SELECT 'offline')"""


def lags(names, value="pm25", window="w"):
    return ", ".join(f"lag({value}, {n}) OVER {window} AS {value}_lag_{n}" for n in names)


def rolling(windows, min_rows=None, suffix="", value="pm25", part="PARTITION BY station ORDER BY ts"):
    columns = []
    for n in windows:
        frame = f"({part} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        enough = f"count({value}) OVER {frame} >= {n if min_rows is None else min_rows}"
        for name, function in (("mean", "avg"), ("std", "stddev_samp")):
            columns.append(
                f"CASE WHEN {enough} THEN {function}({value}) OVER {frame} END"
                f" AS {value}_rolling_{name}_{n}{suffix}"
            )
    return ", ".join(columns)


def calendar(column, hourly=False):
    hour = f"CAST(hour({column}) AS INTEGER) AS hour, " if hourly else ""
    return hour + (
        f"CAST(isodow({column}) - 1 AS INTEGER) AS day_of_week, CAST(month({column}) AS INTEGER) AS month, "
        f"CAST(dayofyear({column}) AS INTEGER) AS day_of_year, "
        f"CAST(CASE WHEN isodow({column}) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"
    )


HOURLY_LAGS = (1, 2, 3, 6, 12, 24)
HOURLY_WIDE = SERIES + f""",
wide AS (
  SELECT station, ts, pm25, {lags(HOURLY_LAGS)}, {rolling((6, 12, 24), suffix="h")},
         lag(pm25, 1) OVER w - lag(pm25, 2) OVER w AS pm25_diff_1h,
         lag(pm25, 1) OVER w - lag(pm25, 25) OVER w AS pm25_diff_24h,
         {calendar("ts", hourly=True)}, lead(pm25, 24) OVER w AS pm25_h24
  FROM series WINDOW w AS (PARTITION BY station ORDER BY ts)),
features AS (SELECT * FROM wide WHERE pm25_diff_24h IS NOT NULL AND pm25_h24 IS NOT NULL)"""

DAILY_LAGS = (1, 2, 3, 5, 7)


def daily_features(source="daily", min_rows=1, keep="pm25_lag_7 IS NOT NULL"):
    part = "PARTITION BY station ORDER BY date"
    return f"""wide AS (
  SELECT station, date, pm25, {lags(DAILY_LAGS)}, {rolling((3, 7, 14), min_rows, part=part)},
         {calendar("date")}, lag(pm25, 1) OVER w - lag(pm25, 2) OVER w AS pm25_diff_1,
         lag(pm25, 1) OVER w / lag(pm25, 2) OVER w - 1 AS pm25_pct_change_1
  FROM {source} WINDOW w AS ({part})),
features AS (SELECT * FROM wide WHERE {keep})"""


def psi(samples="samples", keys="station", bins=10):
    """CTEs ending in `psi_result` (keys, psi) from (keys, is_actual, value)."""
    probs = ", ".join(str(i / bins) for i in range(bins + 1))
    using = f"USING ({keys})"
    return f"""
edges AS (
  SELECT {keys}, list_sort(list_distinct(list_transform(quantile_cont(value, [{probs}]), lambda e: round(e, 9)))) AS e
  FROM {samples} GROUP BY {keys}),
totals AS (
  SELECT {keys}, count(*) FILTER (NOT is_actual) AS ne, count(*) FILTER (is_actual) AS na
  FROM {samples} GROUP BY {keys}),
binned AS (
  SELECT {keys}, len(list_filter(e[2:-2], lambda x: x <= round(value, 9))) AS bin, is_actual
  FROM {samples} JOIN edges {using}),
shares AS (
  SELECT {keys}, bin, count(*) FILTER (NOT is_actual) AS ce, count(*) FILTER (is_actual) AS ca
  FROM binned GROUP BY {keys}, bin),
filled AS (
  SELECT {keys}, CASE WHEN ce = 0 THEN 0.0001::DOUBLE ELSE ce / ne END AS pe,
         CASE WHEN ca = 0 THEN 0.0001::DOUBLE ELSE ca / na END AS pa
  FROM shares JOIN totals {using}),
psi_result AS (
  SELECT {keys}, CASE WHEN len(any_value(e)) < 3 THEN 0.0::DOUBLE
                 ELSE round(sum((pa - pe) * ln(pa / pe)), 4) END AS psi
  FROM filled JOIN edges {using} GROUP BY {keys})"""


def metrics(source, by, places=4):
    """CTE `metrics` (by, n, mae, rmse, r2)."""
    return f"""metrics AS (
  SELECT {by}, count(*) AS n, round(avg(abs(actual - predicted)), {places}) AS mae,
         round(sqrt(avg((actual - predicted) ** 2)), {places}) AS rmse,
         CASE WHEN count(*) < 2 THEN NULL
              WHEN var_pop(actual) = 0 THEN CASE WHEN avg((actual - predicted) ** 2) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
              ELSE round(1 - avg((actual - predicted) ** 2) / var_pop(actual), {places}) END AS r2
  FROM {source} GROUP BY ALL)"""
