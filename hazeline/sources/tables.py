"""Parquet tables: scans, logs, feature hand-off and the layout by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
# Fixed schemas of the stored tables.
READINGS_SCHEMA = (
    "station_id int, station_name string, station_name_en string, ts timestamp_ntz, pm25 double, "
    "pm10 double, temp double, rh double, ws double, wd double, ingestion_time timestamp_ntz"
)
PREDICTION_LOG_SCHEMA = "prediction_date date, predicted_pm25 double, model string, created_at timestamp_ntz"
ACTUAL_LOG_SCHEMA = "date date, pm25_actual double, recorded_at timestamp_ntz"


def scan_station(
    table: DataFrame, station: str | None, since: Column, value: str = "pm25", order: str = "ts"
) -> DataFrame:
    """(station, order, value) from `since`, non-null; the filters reach the Parquet scan."""
    rows = table.filter((F.col(order) >= since) & F.col(value).isNotNull())
    if station is not None:
        rows = rows.filter(F.col("station") == station)
    return rows.select("station", order, value)


def scan_jdbc(
    spark: SparkSession, url: str, table: str, since: str, until: str, partitions: int, order: str = "ts", **options: str
) -> DataFrame:
    """The same scan over a database table, read in parallel slices of the time column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=order,
            lowerBound=since,
            upperBound=until,
            numPartitions=str(partitions),
            **options,
        )
        .load()
        .filter((F.col(order) >= F.lit(since)) & (F.col(order) < F.lit(until)))
    )


def read_log(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if kind == "csv" else reader.parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_features(
    df: DataFrame, path: str, by: Sequence[str] = ("station", "split"), order: str = "ts"
) -> None:
    """Feature table partitioned for the readers, which take one split of some stations.

    Rows are ranged by time inside a partition, so a hot station is written by many tasks.
    """
    ranged = df.repartitionByRange(*by, order)
    ranged.write.mode("overwrite").partitionBy(*by).parquet(path)


def load_features(spark: SparkSession, path: str, split: str, stations: Sequence[str] | None = None) -> DataFrame:
    rows = spark.read.parquet(path).filter(F.col("split") == split)
    return rows if stations is None else rows.filter(F.col("station").isin(list(stations)))


def write_by_day(
    df: DataFrame, path: str, mode: str = "append", order: str = "ts", keys: Sequence[str] = ("station",)
) -> None:
    """Append to or overwrite the day partitions that `df` touches.

    Ranging by day, station and time gives few files per day, splits hot days and stations over
    tasks, and keeps each file sorted for row-group skipping.
    """
    layout = ["day", *keys, order]
    (
        df.withColumn("day", F.col(order).cast("date"))
        .repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def touched_days(df: DataFrame, order: str = "ts", keys: Sequence[str] = ("station", "ts")) -> list:
    """The distinct days of a batch, one value per calendar day; a null key raises."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    row = df.agg(F.collect_set(F.col(order).cast("date")).alias("days"), F.count_if(missing).alias("missing")).first()
    if row["missing"]:
        raise ValueError(f"{row['missing']} rows lack a key of {', '.join(keys)}; route them to the rejects first")
    return sorted(row["days"])


def stored_log(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table at `path`, or no rows of `schema` while it does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
