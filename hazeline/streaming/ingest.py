"""Hourly ingest, late data, replay and roll-ups as streams.

Streams use TIMESTAMP, because watermarks do not accept TIMESTAMP_NTZ. State is bounded by the
grace period: deduplication keys and open windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from hazeline.operators.upsert import READING_KEYS
from hazeline.operators.validate import validate
from hazeline.sources.snapshots import decode_snapshots
from hazeline.session import stage_table
from hazeline.sources.tables import append_log, stored_log
from hazeline.sources.versions import insert_ignore_table

LEDGER_SCHEMA = (
    "source string, batch_key string, rows long, valid long, stored long, rejected long, first_ts string, last_ts string"
)
GRACE = "15 minutes"  # fixed value: time that late readings are waited for


def read_stream(
    spark: SparkSession, folder: str, schema: str, file_glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def with_grace(stream: DataFrame, ts: str = "ts", grace: str = GRACE) -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, grace)


def dedupe_stream(stream: DataFrame, keys: Sequence[str] = ("station", "ts")) -> DataFrame:
    """Drop replays of a key that arrive within the grace period."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def rollup_stream(stream: DataFrame, width: str = "1 hour", ts: str = "ts") -> DataFrame:
    """(station, window start and end, mean, readings) of closed tumbling windows."""
    return (
        stream.groupBy("station", F.window(ts, width).alias("_w"))
        .agg(F.avg("pm25").alias("pm25"), F.count("pm25").alias("readings"))
        .select(
            "station",
            F.col("_w.start").alias("start"),
            F.col("_w.end").alias("end"),
            "pm25",
            "readings",
        )
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append the result rows to a Parquet table, and stop."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def batch_key(row: Row) -> str:
    """Name of a batch by its content: number of rows and sum of their hashes."""
    return f"{row['rows']}-{row['hashes']}"


def is_logged(spark: SparkSession, ledger: str, source: str, key: str) -> bool:
    return not stored_log(spark, ledger, LEDGER_SCHEMA).filter(
        (F.col("source") == source) & (F.col("batch_key") == key)
    ).isEmpty()


def store_rejects(bad: DataFrame, path: str, day: Column) -> int:
    """Append the rejects that `path` does not hold yet; the number of new ones.

    A reject is known by its content and, among equal rows of one batch, by its number, so a batch that comes
    again under any checkpoint adds nothing, and no batch overwrites another's. Equal rows are
    counted before they meet, so a flood of them is one row a task. Only the days of the batch are read
    back; rows without a readable time share the day null.
    """
    spark = bad.sparkSession
    content = F.sha2(F.to_json(F.struct(*bad.columns), {"ignoreNullFields": "false"}), 256)
    counted = bad.withColumns({"reject_id": content, "day": day}).groupBy(*bad.columns, "reject_id", "day").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    rows = stage_table(
        counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_copies"), "rejects"
    )
    spans = rows.agg(F.collect_set("day").alias("days"), F.count_if(F.col("day").isNull()).alias("undated")).first()
    if not spans["days"] and not spans["undated"]:
        return 0
    known = stored_log(spark, path, rows.schema)
    dated = F.col("day").isin(spans["days"]) if spans["days"] else F.lit(False)
    known = known.filter(dated | F.col("day").isNull() if spans["undated"] else dated).select("reject_id", "copy")
    fresh = stage_table(rows.join(known, ["reject_id", "copy"], "left_anti"), "new-rejects")
    fresh.write.mode("append").partitionBy("day").parquet(path)
    return fresh.count()


def store_batch(
    batch: DataFrame, batch_id: int, path: str, order: Sequence[str], rejected: str, ledger: str, source: str = "",
    keys: Sequence[str] = READING_KEYS,
) -> None:
    """Insert-ignore the valid rows of a micro-batch; the others go to `rejected` with their reasons.

    The ledger gets one row per batch, last of all: a batch whose content it names for this source is
    skipped, one that failed half-way is done again, and both sinks then find what they hold
    already. Rows without a key are rejects.
    """
    spark = batch.sparkSession
    checked = validate(batch, keys=keys).persist()  # read for the name, the days, the insert and the rejects
    try:
        ts = F.col(keys[-1])
        whole = checked.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.xxhash64(*[F.col(c) for c in batch.columns]).cast("decimal(38,0)")).alias("hashes"),
            F.min(ts).cast("string").alias("first_ts"), F.max(ts).cast("string").alias("last_ts"),
            F.count_if("is_valid").alias("valid"),
        ).first()
        if not whole["rows"] or is_logged(spark, ledger, source, batch_key(whole)):
            return
        bad = checked.filter(~F.col("is_valid"))
        refused = store_rejects(bad, rejected, ts.cast("date")) if whole["valid"] < whole["rows"] else 0
        stored = insert_ignore_table(spark, path, checked.filter("is_valid").select(*batch.columns), order, keys)
        entry = (source, batch_key(whole), whole["rows"], whole["valid"], stored, refused, whole["first_ts"], whole["last_ts"])
        append_log(spark.createDataFrame([entry], LEDGER_SCHEMA), ledger)
    finally:
        checked.unpersist()


def _run(stream: DataFrame, store, checkpoint: str) -> None:
    (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_ingest(
    stream: DataFrame, path: str, checkpoint: str, order: Sequence[str], rejected: str, ledger: str, source: str = ""
) -> None:
    """Validate each micro-batch and insert-ignore its valid rows on (station, ts)."""
    _run(stream, lambda batch, batch_id: store_batch(batch, batch_id, path, order, rejected, ledger, source), checkpoint)


def decode_stream(
    payloads: DataFrame, dim: DataFrame, path: str, checkpoint: str, rejected: str, ledger: str, source: str = ""
) -> None:
    """Decode JSON payloads per micro-batch, validate, and insert-ignore on (station, ts)."""

    def store(batch: DataFrame, batch_id: int) -> None:
        readings = decode_snapshots(batch, dim).withColumnRenamed("station_id", "station")
        store_batch(readings, batch_id, path, ["payload_id"], rejected, ledger, source)

    _run(payloads, store, checkpoint)
