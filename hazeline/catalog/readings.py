"""Sources, parsing, validation, upserts and joins over the test tables."""

from pyspark.sql import functions as F

from hazeline import tables
from hazeline.catalog import sql
from hazeline.catalog.registry import query
from hazeline.functions import parsing, scalar
from hazeline.operators import aggregate, features, gaps, pairs, upsert, validate
from hazeline.session import stage_table, work_dir
from hazeline.sources import sheets, snapshots, versions
from hazeline.sources import tables as stored

SHEET = sql.DAILY + ", days AS (SELECT DISTINCT date FROM daily)"
LIMITS = {"pm25": (0, 200), "pm10": (0, 90)}


# sources


@query(
    "s1_load_station",
    f"""WITH {SHEET} SELECT CAST(d.date AS VARCHAR) AS date, round(pm25, 6) AS pm25
    FROM days d LEFT JOIN daily v ON v.date = d.date AND v.station = '1-URGENT'""",
)
def load_station(spark, sf_dir):
    return sheets.load_station(tables.wide_sheet(spark, sf_dir), "1-URGENT")


@query(
    "s2_unpivot_stations",
    f"""WITH {SHEET}, names AS (SELECT DISTINCT station FROM daily)
    SELECT n.station, CAST(d.date AS VARCHAR) AS date, round(pm25, 6) AS pm25
    FROM days d JOIN names n ON true LEFT JOIN daily v ON v.date = d.date AND v.station = n.station""",
)
def unpivot_stations(spark, sf_dir):
    return sheets.unpivot_stations(tables.wide_sheet(spark, sf_dir))


@query(
    "s3_header_marker",
    """SELECT 'S' || s_suppkey AS station, s_name AS name, CAST(s_nationkey AS VARCHAR) AS detail
    FROM supplier WHERE s_acctbal >= 0""",
)
def header_marker(spark, sf_dir):
    columns = {"Station": "station", "Name": "name", "Detail": "detail"}
    raw = tables.headerless_sheet(spark, sf_dir)
    return sheets.read_with_header_marker(raw, "Station", columns, "station")


@query(
    "s4_read_long",
    """SELECT CAST(l_suppkey AS INTEGER) AS station_id, CAST(l_shipdate AS VARCHAR) AS ts,
    round(l_quantity, 6) AS value FROM lineitem""",
)
def read_long(spark, sf_dir):
    long = tables.long_parameters(spark, sf_dir).select(
        F.col("ts").alias("Date_Time"),
        F.col("station_id").alias("StationID"),
        F.lit("").alias("StationName"),
        F.col("parameter").alias("Parameter"),
        F.col("value").alias("Value"),
    )
    path = work_dir(spark, "long")
    long.write.option("header", True).csv(path)
    return sheets.read_long(spark, path, "PM2.5")


@query(
    "s5_pivot_parameters",
    """SELECT l_suppkey AS station_id, CAST(l_shipdate AS VARCHAR) AS ts, max(l_quantity) AS pm25,
    CAST(NULL AS DOUBLE) AS pm10, CAST(NULL AS DOUBLE) AS temp, max(l_discount) AS rh, max(l_tax) AS ws,
    CAST(NULL AS DOUBLE) AS wd FROM lineitem GROUP BY l_suppkey, l_shipdate""",
)
def pivot_parameters(spark, sf_dir):
    return sheets.pivot_parameters(tables.long_parameters(spark, sf_dir))


@query(
    "s6_scan_station",
    """SELECT event_type AS station, CAST(ts AS VARCHAR) AS ts, round(value, 6) AS pm25
    FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10'""",
)
def scan_station(spark, sf_dir):
    since = F.lit("2024-01-10").cast("timestamp_ntz")
    return stored.scan_station(tables.raw_readings(spark, sf_dir), "click", since)


SNAPSHOT = """decoded AS (
  SELECT event_id AS payload_id, CAST(user_id AS INTEGER) AS station_id, s_name AS station_name,
         n_name AS station_name_en, CAST(date_trunc('minute', ts) AS VARCHAR) AS ts, value AS pm25,
         CASE WHEN CAST(regexp_extract(props, '[0-9]+') AS INTEGER) >= 10
              THEN CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) END AS pm10
  FROM events LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON user_id = s_suppkey)"""


@query("s7_decode_snapshots", f"WITH {SNAPSHOT} SELECT * FROM decoded")
def decode_snapshots(spark, sf_dir):
    dim = tables.station_names(spark, sf_dir).withColumn("station_id", F.col("station_id").cast("int"))
    decoded = snapshots.decode_snapshots(tables.snapshot_payloads(spark, sf_dir), dim)
    return decoded.drop("temp", "rh", "ws", "wd")


K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"


@query(
    "s7_decode_many_stations",
    f"""SELECT CAST(date_trunc('day', ts) AS DATE) - DATE '1970-01-01' AS payload_id, CAST(user_id AS INTEGER) AS station_id,
    any_value(s_name) AS station_name, any_value(n_name) AS station_name_en, CAST(date_trunc('hour', ts) AS VARCHAR) AS ts,
    round(max(value), 6) AS pm25, max({K})::DOUBLE AS pm10, min({K})::DOUBLE AS temp, count(*)::DOUBLE AS rh,
    CASE WHEN min({K}) >= 10 THEN min({K}) END::DOUBLE AS ws, CAST(NULL AS DOUBLE) AS wd
    FROM events LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON user_id = s_suppkey
    GROUP BY date_trunc('day', ts), user_id, date_trunc('hour', ts)""",
)
def decode_many_stations(spark, sf_dir):
    """Payloads of a day: many stations, a row per hour, six measures, every alias listed twice."""
    dim = tables.station_names(spark, sf_dir).withColumn("station_id", F.col("station_id").cast("int"))
    payloads = stage_table(tables.daily_payloads(spark, sf_dir), "payloads", **snapshots.LARGE_PAYLOADS)
    return snapshots.decode_snapshots(payloads, dim)


def raw_stations(spark, sf_dir):
    names = tables.station_names(spark, sf_dir)
    supplier = tables.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    joined = names.join(supplier, F.col("station_id") == F.col("s_suppkey"))
    raw = joined.select(
        F.when(F.col("s_acctbal") >= 0, F.col("station_id")).alias("MeasIndex"),
        F.col("station_name").alias("District"),
        F.col("station_name_en").alias("District_en"),
    )
    overrides = joined.filter(F.col("s_nationkey") == 0).select(
        F.col("station_id").cast("int").alias("station_id"),
        F.concat(F.lit("Renamed "), "station_name").alias("override"),
    )
    return raw, overrides


@query(
    "s8_station_dim",
    """SELECT CAST(s_suppkey AS INTEGER) AS station_id, s_name AS station_name,
    CASE WHEN s_nationkey = 0 THEN 'Renamed ' || s_name ELSE n_name END AS station_name_en
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0""",
)
def station_dim(spark, sf_dir):
    return snapshots.station_dim(*raw_stations(spark, sf_dir))


@query(
    "s9_resolve_stations",
    """SELECT CAST(position AS INTEGER) AS position, CAST(station_id AS INTEGER) AS station_id
    FROM (VALUES (0, 9), (1, 5), (2, 999999), (3, 0), (4, 7)) v(position, station_id)
    WHERE station_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
)
def resolve_stations(spark, sf_dir):
    dim = snapshots.station_dim(*raw_stations(spark, sf_dir))
    return snapshots.resolve_stations(dim, (9, 5, 999999, 0, 7))


@query(
    "s10_read_log",
    """SELECT CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) AS prediction_date,
    round(floor(o_totalprice) / 1000, 6) AS predicted_pm25, o_orderpriority AS model,
    CAST(o_orderdate AS VARCHAR) AS created_at FROM orders""",
)
def read_log(spark, sf_dir):
    log = tables.prediction_log(spark, sf_dir).select(
        F.col("date").alias("prediction_date"),
        F.col("predicted").alias("predicted_pm25"),
        F.col("station").alias("model"),
        F.date_sub("date", 1).cast("timestamp_ntz").alias("created_at"),
    )
    path = work_dir(spark, "log")
    log.write.option("header", True).csv(path)
    return stored.read_log(spark, path, stored.PREDICTION_LOG_SCHEMA, "csv")


@query(
    "s11_feature_handoff",
    f"""WITH {sql.HOURLY_WIDE} SELECT station, CAST(ts AS VARCHAR) AS ts, round(pm25_lag_1, 6) AS pm25_lag_1,
    round(pm25_h24, 6) AS pm25_h24 FROM features WHERE ts >= TIMESTAMP '2024-01-20'""",
)
def feature_handoff(spark, sf_dir):
    series = gaps.hourly_series(tables.hourly_readings(spark, sf_dir))
    split = F.when(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"), "train").otherwise("test")
    path = work_dir(spark, "features")
    stored.save_features(features.build_hourly_features(series).withColumn("split", split), path)
    return stored.load_features(spark, path, "test").select("station", "ts", "pm25_lag_1", "pm25_h24")


# parsing


@query(
    "p1_parse_buddhist_ts",
    "SELECT event_id, CAST(date_trunc('minute', ts) AS VARCHAR) AS ts FROM events",
)
def parse_buddhist_ts(spark, sf_dir):
    time = F.get_json_object("body", "$.arrData[0].Date_Time")
    return tables.snapshot_payloads(spark, sf_dir).select(
        F.col("payload_id").alias("event_id"), parsing.parse_buddhist_ts(time).alias("ts")
    )


@query(
    "p2_format_local",
    "SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%d/%m/%Y %H:%M') AS local_time FROM events",
)
def format_local(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", parsing.format_local(F.col("ts")).alias("local_time"))


@query(
    "p3_coerce_float",
    """SELECT event_id, CASE event_type WHEN 'click' THEN round(value * 1000, 2) WHEN 'purchase' THEN value END AS number
    FROM events""",
)
def coerce_float(spark, sf_dir):
    value = F.col("value")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.format_number(value * 1000, 2))
        .when(kind == "purchase", F.concat(F.lit("  "), value.cast("string"), F.lit(" ")))
        .when(kind == "error", "-")
        .when(kind == "signup", "nan")
        .otherwise("broken")
    )
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", parsing.coerce_float(text).alias("number"))


def date_texts(spark, sf_dir):
    date = F.col("o_orderdate")
    kind = F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.date_format(date, "yyyy-MM-dd"))
        .when(kind == "2-HIGH", F.date_format(date, "dd/MM/yyyy"))
        .when(kind == "3-MEDIUM", F.date_format(date, "dd-MM-yyyy"))
        .when(kind == "5-LOW", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(date, "dMMMyyyy"))
    )
    return tables.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))


@query(
    "p4_parse_date_multi",
    """SELECT o_orderkey,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS job_date,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS backfill_date
    FROM orders""",
)
def parse_date_multi(spark, sf_dir):
    text = F.col("text")
    return date_texts(spark, sf_dir).select(
        "o_orderkey",
        parsing.parse_date_multi(text).alias("job_date"),
        parsing.parse_date_multi(text, parsing.BACKFILL_DATE_FORMATS, iso=False).alias("backfill_date"),
    )


@query(
    "p5_local_date",
    """WITH d AS (SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS DATE) AS day FROM events)
    SELECT event_id, CAST(day AS VARCHAR) AS local_date,
    CAST(CAST(day AS TIMESTAMP) - INTERVAL 7 HOUR AS VARCHAR) AS day_start,
    CAST(CAST(day AS TIMESTAMP) + INTERVAL 17 HOUR AS VARCHAR) AS day_end FROM d""",
)
def local_date(spark, sf_dir):
    day = parsing.local_date(F.col("ts"))
    start, end = parsing.day_bounds(day, day)
    return tables.table(spark, sf_dir, "events").select(
        "event_id", day.alias("local_date"), start.alias("day_start"), end.alias("day_end")
    )


@query(
    "p6_clip", "SELECT event_id, least(greatest(value, 5.0::DOUBLE), 200.0::DOUBLE) AS pm25 FROM events"
)
def clip(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", scalar.clip(F.col("value"), 5.0, 200.0).alias("pm25"))


def _ladder_sql(bounds):
    cases = " ".join(f"WHEN value <= {b} THEN '{n}'" for b, n in zip(bounds, scalar.BANDS))
    return f"CASE {cases} ELSE '{scalar.BANDS[-1]}' END"


@query(
    "p7_aq_band",
    f"""SELECT event_id, {_ladder_sql((15, 25, 37.5, 75))} AS strict_band,
    {_ladder_sql((25, 37, 50, 90))} AS local_band FROM events""",
)
def aq_band(spark, sf_dir):
    value = F.col("value")
    return tables.table(spark, sf_dir, "events").select(
        "event_id",
        scalar.aq_band(value).alias("strict_band"),
        scalar.aq_band(value, scalar.LOCAL_LADDER).alias("local_band"),
    )


@query(
    "p8_regime",
    """SELECT event_id, CASE WHEN value < 35 THEN 'low' WHEN value <= 75 THEN 'moderate' ELSE 'high' END AS regime
    FROM events""",
)
def regime(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", scalar.regime(F.col("value")).alias("regime"))


@query(
    "p9_psi_status",
    """SELECT event_id, CASE WHEN value / 500 < 0.1 THEN 'stable' WHEN value / 500 < 0.2 THEN 'moderate'
    ELSE 'significant' END AS status FROM events""",
)
def psi_status(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", scalar.psi_status(F.col("value") / 500).alias("status"))


@query(
    "p10_round",
    "SELECT event_id, CAST(round(CAST(value AS DECIMAL(38,12)), 1) AS DOUBLE) AS pm25 FROM events",
)
def round_values(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", scalar.round_half_up(F.col("value"), 1).alias("pm25"))


@query(
    "p11_explode_history",
    f"""WITH {sql.DAILY}, ranked AS (
      SELECT station, date, pm25 * 1.02 AS pm25, row_number() OVER (PARTITION BY station ORDER BY date) AS rn FROM daily),
    windows AS (
      SELECT station, date, count(*) OVER w AS n, max(pm25) OVER w AS hi, sum(pm25) OVER w AS total, min(date) OVER w AS first_date
      FROM ranked WINDOW w AS (PARTITION BY station ORDER BY rn ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))
    SELECT station, CAST(date AS VARCHAR) AS date, n AS readings, CAST(first_date AS VARCHAR) AS first_date,
    round(total, 6) AS total FROM windows WHERE n = 15 AND hi <= 500""",
)
def explode_history(spark, sf_dir):
    from hazeline.operators.model import explode_history

    rows = explode_history(tables.history_requests(spark, sf_dir))
    return rows.groupBy(F.col("request.station"), F.col("request.date").alias("day")).agg(
        F.count("*").alias("readings"), F.min("date").alias("first_date"), F.sum("pm25").alias("total")
    ).withColumnRenamed("day", "date")


# validation

CHECKED = sql.RAW + """,
masked AS (SELECT event_id, station, ts, pm25, CASE WHEN station <> 'view' THEN pm10 END AS pm10 FROM raw),
checked AS (
  SELECT *, array_to_string(list_filter([
    CASE WHEN NOT pm25 BETWEEN 0 AND 200 THEN 'pm25=' || CAST(pm25 AS VARCHAR) || ' out of range [0, 200]' END,
    CASE WHEN NOT pm10 BETWEEN 0 AND 90 THEN 'pm10=' || CAST(pm10 AS VARCHAR) || ' out of range [0, 90]' END
  ], lambda x: x IS NOT NULL), '; ') AS errors FROM masked)"""


def checked_readings(spark, sf_dir):
    raw = tables.raw_readings(spark, sf_dir)
    masked = raw.withColumn("pm10", F.when(F.col("station") != "view", F.col("pm10")))
    return validate.validate(masked, LIMITS)


@query(
    "f1_validate",
    f"""WITH {CHECKED} SELECT event_id, errors, errors = '' AS is_valid, pm25 IS NULL AS pm25_is_null,
    pm10 IS NULL AS pm10_is_null FROM checked""",
)
def validate_rows(spark, sf_dir):
    return checked_readings(spark, sf_dir).select(
        "event_id", F.array_join("errors", "; ").alias("errors"), "is_valid", "pm25_is_null", "pm10_is_null"
    )


@query(
    "f2_validation_summary",
    f"""WITH {CHECKED} SELECT station, count(*) FILTER (errors = '') AS validated,
    count(*) FILTER (errors <> '') AS failed, round(avg(CASE WHEN errors = '' THEN 1.0 ELSE 0.0 END), 6) AS pass_rate
    FROM checked GROUP BY station""",
)
def validation_summary(spark, sf_dir):
    return validate.validation_summary(checked_readings(spark, sf_dir), ["station"])


@query(
    "f3_check_constraints",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 900 END AS pm25,
    o_totalprice - 20000 AS pm10, (o_orderkey % 150)::DOUBLE AS rh, o_totalprice - 9000 AS ws,
    o_orderkey % 5 AS history_days, o_orderkey % 7 - 1 AS filled_history_days
    FROM orders WHERE (o_orderstatus = 'P' OR o_totalprice / 900 BETWEEN 0 AND 500) AND o_totalprice >= 20000
    AND o_orderkey % 150 <= 100 AND o_orderkey % 5 > 0 AND o_orderkey % 7 >= 1""",
)
def check_constraints(spark, sf_dir):
    """All checks of both tables; each one rejects some rows."""
    orders, price, key = tables.table(spark, sf_dir, "orders"), F.col("o_totalprice"), F.col("o_orderkey")
    rows = orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", price / 900).alias("pm25"), (price - 20000).alias("pm10"),
        (key % 150).cast("double").alias("rh"), (price - 9000).alias("ws"), (key % 5).alias("history_days"),
        (key % 7 - 1).alias("filled_history_days"),
    )
    return validate.check_constraints(rows, validate.READING_CHECKS + validate.PREDICTION_CHECKS)


@query("f4_remove_outliers", "SELECT event_id, value AS pm25 FROM events WHERE value BETWEEN 0 AND 200")
def remove_outliers(spark, sf_dir):
    raw = tables.raw_readings(spark, sf_dir)
    return validate.remove_outliers(raw, 0, 200).select("event_id", "pm25")


@query("f5_positive_only", "SELECT event_id, value AS pm25 FROM events WHERE value > 0")
def positive_only(spark, sf_dir):
    return validate.positive_only(tables.raw_readings(spark, sf_dir)).select("event_id", "pm25")


@query(
    "f6_drop_incomplete",
    f"WITH {sql.GAPPY} SELECT station, CAST(date AS VARCHAR) AS date, round(pm25, 6) AS pm25 FROM gappy WHERE pm25 IS NOT NULL",
)
def drop_incomplete(spark, sf_dir):
    return validate.drop_incomplete(tables.gappy_readings(spark, sf_dir), ["pm25"])


@query(
    "f7_quality_gate",
    f"""WITH {CHECKED}, stats AS (
      SELECT station, count(*) AS "rows", count(*) FILTER (ts > TIMESTAMP '2024-01-30 12:00:00') AS future_rows,
      avg((CASE WHEN pm25 IS NULL THEN 1 ELSE 0 END + CASE WHEN pm10 IS NULL THEN 1 ELSE 0 END) / 2) AS missing_ratio,
      station <> 'error' AS known_station FROM masked GROUP BY station)
    SELECT station, "rows", future_rows, round(missing_ratio, 6) AS missing_ratio, known_station,
    future_rows = 0 AND known_station AND missing_ratio < 0.2 AS passed FROM stats""",
)
def quality_gate(spark, sf_dir):
    rows = checked_readings(spark, sf_dir)
    known = tables.event_stations(spark, sf_dir).filter(F.col("station") != "error")
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return validate.quality_gate(rows, known, as_of)


@query(
    "f8_size_gate",
    f"""WITH {sql.HOURLY}, sized AS (
      SELECT station, count(*) FILTER (ts < TIMESTAMP '2024-01-24') AS train_rows,
      count(*) FILTER (ts >= TIMESTAMP '2024-01-24') AS test_rows FROM readings GROUP BY station)
    SELECT *, CASE WHEN train_rows >= 200 AND test_rows >= 150 THEN 'ok' ELSE 'insufficient_data' END AS status FROM sized""",
)
def size_gate(spark, sf_dir):
    border = F.lit("2024-01-24").cast("timestamp_ntz")
    split = F.when(F.col("ts") < border, "train").otherwise("test")
    rows = tables.hourly_readings(spark, sf_dir).withColumn("split", split)
    return validate.size_gate(rows, {"train": 200, "test": 150})


@query(
    "f8_keep_sized",
    f"""WITH {sql.HOURLY} SELECT station, CAST(ts AS VARCHAR) AS ts, pm25 FROM readings
    QUALIFY count(*) FILTER (ts >= TIMESTAMP '2024-01-24') OVER (PARTITION BY station) >= 158""",
)
def keep_sized(spark, sf_dir):
    rows = tables.hourly_readings(spark, sf_dir)
    late = F.when(F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz"), "test")
    gate = validate.size_gate(rows.withColumn("split", late), {"test": 158})
    return validate.keep_sized(rows, gate)


# upserts: the target holds the events before the 20th, the batch those from the 10th on


def hour_rows(spark, sf_dir):
    from hazeline.plans.series import hour_floor

    return tables.raw_readings(spark, sf_dir).withColumn("ts", hour_floor(F.col("ts")))


def target_and_batch(spark, sf_dir):
    rows = hour_rows(spark, sf_dir)
    time = lambda text: F.lit(text).cast("timestamp_ntz")
    target = upsert.dedupe_first(
        rows.filter(F.col("ts") < time("2024-01-20")), ["station", "ts"], ["event_id"]
    )
    batch = rows.filter(F.col("ts") >= time("2024-01-10")).withColumn("pm25", F.col("pm25") + 1)
    return target, batch


SLOTS = sql.RAW + """,
slots AS (SELECT event_id, station, date_trunc('hour', ts) AS ts, pm25, pm10 FROM raw),
target AS (
  SELECT * FROM slots WHERE ts < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1),
batch AS (SELECT event_id, station, ts, pm25 + 1 AS pm25, pm10 FROM slots WHERE ts >= TIMESTAMP '2024-01-10'),
fresh AS (
  SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.station = b.station AND t.ts = b.ts)
  QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1)"""
ROW = "event_id, station, CAST(ts AS VARCHAR) AS ts, round(pm25, 6) AS pm25, pm10"


@query(
    "k1_insert_ignore",
    f"WITH {SLOTS}, merged AS (SELECT * FROM target UNION ALL SELECT * FROM fresh) SELECT {ROW} FROM merged",
)
def insert_ignore(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.insert_ignore(target, batch, ["event_id"])


@query(
    "k1_insert_counts",
    f"""WITH {SLOTS} SELECT (SELECT count(*) FROM fresh) AS inserted,
    (SELECT count(*) FROM batch) - (SELECT count(*) FROM fresh) AS duplicates""",
)
def insert_counts(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.insert_counts(batch, upsert.new_rows(target, batch, ["event_id"]))


@query(
    "k2_upsert",
    f"""WITH {SLOTS}, newest AS (
      SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id DESC) = 1),
    merged AS (
      SELECT * FROM newest UNION ALL
      SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.station = t.station AND n.ts = t.ts))
    SELECT {ROW} FROM merged""",
)
def upsert_rows(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.upsert(target, batch, ["event_id"], ["station", "ts"])


@query(
    "k3_delete_range",
    f"""WITH {sql.RAW} SELECT event_id FROM raw
    WHERE NOT (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15' AND station IN ('click', 'view'))""",
)
def delete_range(spark, sf_dir):
    rows = tables.raw_readings(spark, sf_dir)
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-05", "2024-01-15"))
    return upsert.delete_range(rows, start, end, ["click", "view"]).select("event_id")


@query(
    "k4_delete_date_range",
    """SELECT o_orderkey AS entry FROM orders WHERE NOT (
    CAST(o_orderdate AS DATE) + 1 BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
    AND o_orderpriority IN ('1-URGENT', '2-HIGH'))""",
)
def delete_date_range(spark, sf_dir):
    log = tables.prediction_log(spark, sf_dir)
    first, last = (F.lit(t).cast("date") for t in ("1996-01-01", "1998-12-31"))
    kept = upsert.delete_date_range(log, first, last, ["1-URGENT", "2-HIGH"], order="date")
    return kept.select("entry")


@query(
    "k5_delete_keys",
    f"WITH {SLOTS} SELECT {ROW} FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.station = t.station AND b.ts = t.ts)",
)
def delete_keys(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.delete_keys(target, batch, ["station", "ts"])


REPLACED = SLOTS + """,
kept AS (SELECT * FROM target WHERE NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15')),
fresh_in AS (
  SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM kept t WHERE t.station = b.station AND t.ts = b.ts)
  QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1)"""


def replaced_range():
    return [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10", "2024-01-15")]


@query(
    "k6_replace_range",
    f"WITH {REPLACED}, merged AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh_in) SELECT {ROW} FROM merged",
)
def replace_range(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.replace_range(target, batch, *replaced_range(), ["event_id"])


@query(
    "k6_replace_counts",
    f"""WITH {REPLACED} SELECT (SELECT count(*) FROM target) - (SELECT count(*) FROM kept) AS deleted,
    (SELECT count(*) FROM fresh_in) AS inserted,
    (SELECT count(*) FROM batch) - (SELECT count(*) FROM fresh_in) AS duplicates""",
)
def replace_counts(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.replace_range_counts(target, batch, *replaced_range(), ["event_id"])


PART_OF_DAY = "station = 'click' AND ts >= TIMESTAMP '2024-01-12 06:00:00' AND ts < TIMESTAMP '2024-01-13 02:00:00'"


@query(
    "k6_replace_range_table",
    f"""WITH {SLOTS}, part AS (SELECT * FROM batch WHERE {PART_OF_DAY} AND hour(ts) % 2 = 0),
    kept AS (SELECT * FROM target WHERE NOT ({PART_OF_DAY})),
    merged AS (SELECT * FROM kept UNION ALL SELECT * FROM part
      QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1)
    SELECT {ROW} FROM merged""",
)
def replace_range_table(spark, sf_dir):
    """A backfill of one station and parts of two days, run twice, leaves everything else."""
    target, batch = target_and_batch(spark, sf_dir)
    part = batch.filter(PART_OF_DAY).filter(F.hour("ts") % 2 == 0)
    path = work_dir(spark, "readings")
    versions.insert_ignore_table(spark, path, target, ["event_id"])
    bounds = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-12 06:00:00", "2024-01-13 02:00:00")]
    for _ in range(2):
        versions.replace_range_table(spark, path, part, *bounds, ["event_id"], ["click"])
    return versions.read_table(spark, path).drop("day")


@query(
    "k7_replace_predictions",
    f"""WITH {sql.LOGS}, old AS (
      SELECT * FROM predictions WHERE date < DATE '1998-01-01'
      QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry) = 1),
    batch AS (SELECT * FROM predictions WHERE date >= DATE '1997-01-01'),
    newest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry DESC) = 1),
    merged AS (
      SELECT * FROM newest UNION ALL
      SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.station = o.station AND n.date = o.date))
    SELECT station, CAST(date AS VARCHAR) AS date, round(predicted, 6) AS predicted, entry FROM merged""",
)
def replace_predictions(spark, sf_dir):
    log = tables.prediction_log(spark, sf_dir)
    day = lambda text: F.lit(text).cast("date")
    keys = ["station", "date"]
    old = upsert.dedupe_first(log.filter(F.col("date") < day("1998-01-01")), keys, ["entry"])
    batch = log.filter(F.col("date") >= day("1997-01-01"))
    return upsert.replace_predictions(
        old, batch, day("1997-01-01"), day("2001-12-31"), ["entry"], keys=keys
    )


@query(
    "k7_replace_predictions_table",
    f"""WITH {sql.LOGS}, old AS (
      SELECT * FROM predictions WHERE date >= DATE '1998-11-01'
      QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry DESC) = 1),
    newest AS (SELECT station, date, predicted + 1 AS predicted, entry FROM old WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-02-15'),
    merged AS (
      SELECT * FROM newest UNION ALL
      SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.station = o.station AND n.date = o.date))
    SELECT station, CAST(date AS VARCHAR) AS prediction_date, round(predicted, 6) AS predicted, entry FROM merged
    WHERE NOT (date BETWEEN DATE '1999-02-01' AND DATE '1999-03-31' AND station IN ('1-URGENT', '5-LOW'))
    AND NOT (date BETWEEN DATE '1998-12-01' AND DATE '1998-12-24')""",
)
def replace_predictions_table(spark, sf_dir):
    """The sink by day: rows arrive, some keys are replaced, a range goes for two stations, another
    for all of them, so that its days disappear."""
    rows = tables.prediction_log(spark, sf_dir).withColumnRenamed("date", "prediction_date")
    day, path = F.col("prediction_date"), work_dir(spark, "predictions")
    kept = stage_table(rows.filter(day >= F.lit("1998-11-01").cast("date")), "kept-log")
    versions.upsert_table(spark, path, kept, ["entry"])
    again = kept.filter(day.between(*[F.lit(t).cast("date") for t in ("1999-01-01", "1999-02-15")]))
    versions.upsert_table(spark, path, again.withColumn("predicted", F.col("predicted") + 1), ["entry"])
    versions.delete_dates_table(spark, path, "1999-02-01", "1999-03-31", ["1-URGENT", "5-LOW"])
    versions.delete_dates_table(spark, path, "1998-12-01", "1998-12-24")
    return versions.read_table(spark, path).drop("day")


@query(
    "k8_dedupe_latest",
    f"""WITH {sql.LOGS} SELECT station, CAST(date AS VARCHAR) AS date, round(predicted, 6) AS predicted, entry
    FROM predictions QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry DESC) = 1""",
)
def dedupe_latest(spark, sf_dir):
    return upsert.dedupe_latest(tables.prediction_log(spark, sf_dir), ["station", "date"], ["entry"])


@query(
    "k9_dedupe_first",
    f"WITH {SLOTS} SELECT {ROW} FROM slots QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1",
)
def dedupe_first(spark, sf_dir):
    return upsert.dedupe_first(hour_rows(spark, sf_dir), ["station", "ts"], ["event_id"])


@query(
    "k10_key_exists",
    f"""WITH {SLOTS} SELECT b.event_id, t.station IS NOT NULL AS "exists"
    FROM batch b LEFT JOIN target t ON t.station = b.station AND t.ts = b.ts""",
)
def key_exists(spark, sf_dir):
    target, batch = target_and_batch(spark, sf_dir)
    return upsert.key_exists(batch, target).select("event_id", "exists")


@query(
    "k11_append_log",
    f"WITH {sql.LOGS} SELECT station, CAST(date AS VARCHAR) AS date, round(predicted, 6) AS predicted, entry FROM predictions",
)
def append_log(spark, sf_dir):
    log = tables.prediction_log(spark, sf_dir)
    early = F.col("date") < F.lit("1998-01-01").cast("date")
    path = work_dir(spark, "log")
    stored.append_log(log.filter(early), path)
    stored.append_log(log.filter(~early), path)
    return stored.read_log(spark, path, "station string, date date, predicted double, entry bigint")


# joins


@query(
    "j1_pair_predictions",
    f"""WITH {sql.PAIRS} SELECT station, CAST(date AS VARCHAR) AS date, round(predicted, 6) AS predicted,
    round(actual, 6) AS actual FROM pairs""",
)
def pair_predictions(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return pairs.pair_predictions(*logs, ["entry"])


@query(
    "j2_pair_raw",
    f"""WITH {sql.LOGS} SELECT p.station, CAST(p.date AS VARCHAR) AS date, count(*) AS pairs,
    round(sum(predicted - actual), 6) + 0.0 AS error_sum
    FROM predictions p JOIN actuals a ON p.station = a.station AND p.date = a.date GROUP BY ALL""",
)
def pair_raw(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return pairs.pair_raw(*logs)


@query(
    "j2_raw_pairs_mae",
    f"""WITH {sql.LOGS} SELECT p.station, count(*) AS pairs, round(avg(abs(actual - predicted)), 6) AS mae
    FROM predictions p JOIN actuals a ON p.station = a.station AND p.date = a.date GROUP BY p.station""",
)
def raw_pairs_mae(spark, sf_dir):
    logs = tables.prediction_log(spark, sf_dir), tables.actual_log(spark, sf_dir)
    return pairs.raw_pairs(*logs).groupBy("station").agg(
        F.count("*").alias("pairs"), F.avg("absolute_error").alias("mae")
    )


@query(
    "j3_match_actuals",
    f"""WITH {sql.LOGS} SELECT a.entry, round(predicted, 6) AS matched_prediction,
    round(abs(actual - predicted), 6) AS absolute_error
    FROM actuals a LEFT JOIN (
      SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY station, date ORDER BY entry DESC) = 1) p
    ON p.station = a.station AND p.date = a.date""",
)
def match_actuals(spark, sf_dir):
    logs = tables.actual_log(spark, sf_dir), tables.prediction_log(spark, sf_dir)
    return pairs.match_actuals(*logs, ["entry"], places=6).select(
        "entry", "matched_prediction", "absolute_error"
    )


@query(
    "j4_join_calendar",
    f"""WITH {sql.DAILY}, days AS (
      SELECT station, CAST(unnest(generate_series(DATE '1996-01-01', DATE '1997-12-31', INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT DISTINCT station FROM daily))
    SELECT c.station, CAST(c.date AS VARCHAR) AS date, round(pm25, 6) AS pm25
    FROM days c LEFT JOIN daily d ON d.station = c.station AND d.date = c.date""",
)
def join_calendar(spark, sf_dir):
    return gaps.join_calendar(tables.daily_readings(spark, sf_dir), "1996-01-01", "1997-12-31")


@query(
    "j5_reindex_hourly",
    f"WITH {sql.GRID} SELECT station, CAST(ts AS VARCHAR) AS ts, pm25 FROM grid",
)
def reindex_hourly(spark, sf_dir):
    return gaps.hourly_grid(tables.hourly_readings(spark, sf_dir)).select("station", "ts", "pm25")


@query(
    "j6_station_names",
    """SELECT l_orderkey, l_linenumber, l_suppkey AS station_id, s_name AS station_name, n_name AS station_name_en
    FROM lineitem LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey) ON l_suppkey = s_suppkey""",
)
def station_names(spark, sf_dir):
    items = tables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("station_id")
    )
    return pairs.with_station_names(items, tables.station_names(spark, sf_dir))


@query(
    "j7_rolling_pairs",
    f"""WITH {sql.DAILY}, made AS (SELECT station, date + 1 AS date, pm25 AS predicted, date AS created FROM daily)
    SELECT m.station, CAST(m.date AS VARCHAR) AS date, round(predicted, 6) AS predicted, round(pm25, 6) AS actual
    FROM made m JOIN daily d ON d.station = m.station AND d.date = m.date WHERE created >= DATE '2001-07-18'""",
)
def rolling_pairs(spark, sf_dir):
    daily = tables.daily_readings(spark, sf_dir)
    made = daily.select(
        "station",
        F.date_add("date", 1).alias("date"),
        F.col("pm25").alias("predicted"),
        F.col("date").cast("timestamp_ntz").alias("created_at"),
    )
    actual = daily.withColumnRenamed("pm25", "actual")
    as_of = F.lit("2001-08-01").cast("timestamp_ntz")
    return pairs.rolling_pairs(made, actual, as_of).drop("created_at")


@query(
    "a17_ingest_metrics",
    f"""WITH {CHECKED}, hours AS (SELECT DISTINCT station, date_trunc('hour', ts) AS ts FROM checked WHERE errors = ''),
    n AS (SELECT count(*) AS fetched, count(*) FILTER (errors = '') AS valid FROM checked),
    s AS (SELECT count(*) AS stored FROM hours)
    SELECT fetched AS fetched_records, fetched - valid AS validation_failures, stored AS stored_records,
    valid - stored AS duplicates_skipped, round(valid / fetched, 6) AS validation_pass_rate FROM n, s""",
)
def ingest_metrics(spark, sf_dir):
    from hazeline.plans.series import hour_floor

    checked = checked_readings(spark, sf_dir).withColumn("ts", hour_floor(F.col("ts")))
    valid = checked.filter("is_valid")
    return aggregate.ingest_metrics(checked, upsert.new_rows(valid.limit(0), valid, ["event_id"]))
