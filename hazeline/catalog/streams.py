"""Streaming queries: each replays the event table as a stream and reads the written result."""

from pyspark.sql import functions as F

from hazeline import tables
from hazeline.catalog import sql
from hazeline.catalog.readings import SNAPSHOT
from hazeline.catalog.registry import query
from hazeline.plans.series import hour_floor
from hazeline.session import work_dir
from hazeline.sources import versions
from hazeline.streaming import ingest


def event_stream(spark, sf_dir):
    schema = tables.table(spark, sf_dir, "events").schema.simpleString()
    fields = schema.removeprefix("struct<").removesuffix(">").replace(":", " ")
    events = ingest.read_stream(spark, sf_dir, fields, "events.parquet")
    return events.select(
        "event_id",
        F.col("event_type").alias("station"),
        "ts",
        F.col("value").alias("pm25"),
        F.get_json_object("props", "$.k").cast("double").alias("pm10"),
    )


@query(
    "t1_ingest_stream",
    f"""WITH {sql.RAW}, slots AS (SELECT event_id, station, date_trunc('hour', ts) AS ts, pm25, pm10 FROM raw WHERE pm25 <= 500)
    SELECT event_id, station, CAST(ts AS VARCHAR) AS ts, pm25, pm10 FROM slots
    QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY event_id) = 1""",
)
def ingest_stream(spark, sf_dir):
    path = work_dir(spark, "ingested")
    for run in ("first", "replay"):  # the replay must not add rows
        stream = event_stream(spark, sf_dir).withColumn("ts", hour_floor(F.col("ts")))
        ingest.run_ingest(stream, path, work_dir(spark, run), ["event_id"], f"{path}-bad", f"{path}-ledger")
    return versions.read_table(spark, path).drop("day")


@query(
    "t1_rejects_of_two_runs",
    f"""WITH {sql.RAW} SELECT 'rejected' AS kind, event_id, station, CAST(ts AS VARCHAR) AS ts, pm25 FROM raw WHERE pm25 > 500
    UNION ALL SELECT 'rejected', event_id, station, NULL, pm25 FROM raw WHERE pm25 <= 500 AND event_id % 97 = 0
    UNION ALL SELECT 'stored', event_id, station, CAST(ts AS VARCHAR), pm25 FROM (
      SELECT event_id, station, date_trunc('hour', ts) AS ts, pm25 FROM raw WHERE pm25 <= 500 AND event_id % 97 <> 0
      QUALIFY row_number() OVER (PARTITION BY station, date_trunc('hour', raw.ts) ORDER BY event_id % 2, event_id) = 1)""",
)
def rejects_of_two_runs(spark, sf_dir):
    """Even events first, then the odd ones from a new checkpoint, then all of them once more: no
    reject is lost or doubled. Rejects keep their own times, stored rows are hourly."""
    path = work_dir(spark, "ingested")
    even = F.col("event_id") % 2 == 0
    for run, keep in (("even", even), ("odd", ~even), ("again", F.lit(True))):
        stream = event_stream(spark, sf_dir).filter(keep)
        lost = (F.col("event_id") % 97 == 0) & (F.col("pm25") <= 500)
        ts = F.when(lost, F.lit(None)).when(F.col("pm25") > 500, F.col("ts")).otherwise(hour_floor(F.col("ts")))
        ingest.run_ingest(
            stream.withColumn("ts", ts), path, work_dir(spark, run), ["event_id"], f"{path}-bad", f"{path}-ledger", "events"
        )
    kinds = [("stored", versions.read_table(spark, path)), ("rejected", spark.read.parquet(f"{path}-bad"))]
    parts = [df.select(F.lit(kind).alias("kind"), "event_id", "station", "ts", "pm25") for kind, df in kinds]
    return parts[0].unionByName(parts[1])


@query(
    "t1_run_log",
    f"""WITH {sql.RAW}, parts AS (SELECT event_id % 2 AS part, event_id, station, date_trunc('hour', ts) AS ts, pm25 FROM raw),
    firsts AS (SELECT part, count(*) AS stored FROM (
      SELECT part FROM parts WHERE pm25 <= 500 QUALIFY row_number() OVER (PARTITION BY station, ts ORDER BY part, event_id) = 1) GROUP BY part)
    SELECT CASE part WHEN 0 THEN 'even' ELSE 'odd' END AS source, count(*) AS "rows", count(*) FILTER (pm25 <= 500) AS valid,
      any_value(stored) AS stored, count(*) FILTER (pm25 > 500) AS rejected, CAST(min(ts) AS VARCHAR) AS first_ts,
      CAST(max(ts) AS VARCHAR) AS last_ts FROM parts JOIN firsts USING (part) GROUP BY part""",
)
def run_log(spark, sf_dir):
    """The ledger of two sources, each delivered twice: one row per batch, with its counts."""
    path = work_dir(spark, "ingested")
    for run in ("first", "replay"):
        for source, rest in (("even", 0), ("odd", 1)):
            stream = event_stream(spark, sf_dir).withColumn("ts", hour_floor(F.col("ts"))).filter(F.col("event_id") % 2 == rest)
            ingest.run_ingest(
                stream, path, work_dir(spark, run), ["event_id"], f"{path}-bad", f"{path}-ledger", source
            )
    return spark.read.parquet(f"{path}-ledger").drop("batch_key")


@query(
    "t1_decode_stream",
    f"""WITH {SNAPSHOT} SELECT * FROM decoded WHERE pm25 <= 500
    QUALIFY row_number() OVER (PARTITION BY station_id, ts ORDER BY payload_id) = 1""",
)
def decode_stream(spark, sf_dir):
    source = work_dir(spark, "payloads")
    tables.snapshot_payloads(spark, sf_dir).write.parquet(source)
    dim = tables.station_names(spark, sf_dir).withColumn("station_id", F.col("station_id").cast("int"))
    payloads = ingest.read_stream(spark, source, "payload_id bigint, body string")
    path = work_dir(spark, "decoded")
    ingest.decode_stream(payloads, dim, path, work_dir(spark, "decode-state"), f"{path}-bad", f"{path}-ledger")
    return versions.read_table(spark, path).withColumnRenamed("station", "station_id").drop(
        "day", "temp", "rh", "ws", "wd"
    )


@query(
    "t1_decode_rejects",
    f"""WITH {SNAPSHOT}, good AS (
      SELECT * FROM decoded WHERE pm25 <= 500 AND payload_id % 7 <> 0
      QUALIFY row_number() OVER (PARTITION BY station_id, ts ORDER BY payload_id) = 1)
    SELECT 'stored' AS kind, payload_id FROM good UNION ALL
    SELECT 'rejected', payload_id FROM decoded WHERE pm25 > 500 OR payload_id % 7 = 0""",
)
def decode_rejects(spark, sf_dir):
    """Payloads with an unreadable time are rejects; a full replay stores nothing twice."""
    source, path, bad = (work_dir(spark, n) for n in ("payloads", "decoded", "rejects"))
    rows = tables.snapshot_payloads(spark, sf_dir)
    broken = F.regexp_replace("body", '"Date_Time":"[^"]*"', '"Date_Time":"soon"')
    rows.withColumn("body", F.when(F.col("payload_id") % 7 == 0, broken).otherwise(F.col("body"))).write.parquet(source)
    dim = tables.station_names(spark, sf_dir).withColumn("station_id", F.col("station_id").cast("int"))
    for run in ("first", "replay"):
        payloads = ingest.read_stream(spark, source, "payload_id bigint, body string")
        ingest.decode_stream(payloads, dim, path, work_dir(spark, run), bad, f"{path}-ledger")
    kinds = [("stored", versions.read_table(spark, path)), ("rejected", spark.read.parquet(bad))]
    parts = [df.select(F.lit(kind).alias("kind"), "payload_id") for kind, df in kinds]
    return parts[0].unionByName(parts[1])


@query(
    "t2_with_grace",
    f"""WITH {sql.RAW} SELECT station, CAST(date_trunc('day', ts) AS VARCHAR) AS "start", count(*) AS readings FROM raw
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) FROM raw) - INTERVAL 15 MINUTE GROUP BY ALL""",
)
def with_grace(spark, sf_dir):
    stream = ingest.with_grace(event_stream(spark, sf_dir))
    path = work_dir(spark, "daily")
    ingest.run_to_table(ingest.rollup_stream(stream, "1 day"), path, work_dir(spark, "daily-state"))
    return spark.read.parquet(path).select("station", "start", "readings")


@query(
    "t3_dedupe_stream",
    f"WITH {sql.RAW} SELECT DISTINCT station, CAST(date_trunc('hour', ts) AS VARCHAR) AS ts FROM raw",
)
def dedupe_stream(spark, sf_dir):
    hours = event_stream(spark, sf_dir).select("station", hour_floor(F.col("ts")).alias("ts"))
    unique = ingest.dedupe_stream(ingest.with_grace(hours))
    path = work_dir(spark, "unique")
    ingest.run_to_table(unique, path, work_dir(spark, "unique-state"))
    return spark.read.parquet(path)


@query(
    "t4_rollup_stream",
    f"""WITH {sql.RAW} SELECT station, CAST(date_trunc('hour', ts) AS VARCHAR) AS "start",
    CAST(date_trunc('hour', ts) + INTERVAL 1 HOUR AS VARCHAR) AS "end", round(sum(pm25), 2) AS total, count(pm25) AS readings FROM raw
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM raw) - INTERVAL 15 MINUTE GROUP BY ALL""",
)
def rollup_stream(spark, sf_dir):
    stream = ingest.with_grace(event_stream(spark, sf_dir))
    path = work_dir(spark, "hourly")
    ingest.run_to_table(ingest.rollup_stream(stream), path, work_dir(spark, "hourly-state"))
    # the total compares exactly where the last digit of a mean may not
    total = F.round(F.col("pm25") * F.col("readings"), 2)
    return spark.read.parquet(path).withColumn("total", total).drop("pm25")
