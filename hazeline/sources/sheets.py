"""Exported sheets and long parameter files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.parsing import coerce_float

# Provider parameter names and the columns they become.
PARAMETER_FIELDS = {
    "PM2.5": "pm25",
    "PM10": "pm10",
    "Temp": "temp",
    "RH": "rh",
    "WS": "ws",
    "WD": "wd",
}
LONG_SCHEMA = "Date_Time timestamp_ntz, StationID int, StationName string, Parameter string, Value double"


def load_station(wide: DataFrame, station: str, date_column: str = "Date") -> DataFrame:
    """(date, pm25) of one station column; rows without a valid date are dropped."""
    if station not in wide.columns:
        raise ValueError(f"station {station!r} is not in the sheet")
    parsed = F.col(date_column).cast("string").try_cast("date")
    return wide.select(
        parsed.alias("date"), coerce_float(F.col(f"`{station}`")).alias("pm25")
    ).filter(F.col("date").isNotNull())


def unpivot_stations(wide: DataFrame, date_column: str = "Date") -> DataFrame:
    """(station, date, pm25) of every station column."""
    stations = [c for c in wide.columns if c != date_column]
    text = wide.select(
        F.col(date_column).cast("string").try_cast("date").alias("date"),
        *[F.col(f"`{c}`").cast("string").alias(c) for c in stations],
    ).filter(F.col("date").isNotNull())
    long = text.unpivot(["date"], [F.col(f"`{c}`") for c in stations], "station", "pm25")
    return long.select("station", "date", coerce_float(F.col("pm25")).alias("pm25"))


def read_with_header_marker(
    raw: DataFrame, marker: str, columns: Mapping[str, str], required: str, search_rows: int = 10
) -> DataFrame:
    """Rows below the first of the top rows that holds `marker`, named by that header row.

    `raw` has `row_no` and string cells c0, c1, ...; `columns` maps header text to output names.
    The header is one row, found by a scalar subquery, so nothing is collected. Without a header
    row the job fails.
    """
    cells = F.array(*[F.col(c) for c in raw.columns if c != "row_no"])
    top = raw.filter((F.col("row_no") < search_rows) & F.array_contains(cells, marker))
    found = F.min_by(F.struct(F.col("row_no").alias("at"), cells.alias("names")), "row_no")
    missing = F.raise_error(F.lit(f"no header with {marker!r} in the first {search_rows} rows"))
    header = top.agg(F.coalesce(found, missing.cast("struct<at:int,names:array<string>>")).alias("h")).scalar()
    below = raw.select("row_no", cells.alias("_cells"), header.alias("_h")).filter(
        F.col("row_no") > F.col("_h.at")
    )
    cell = lambda name: F.get("_cells", F.array_position("_h.names", name).cast("int") - 1)
    named = below.select(*[cell(text).alias(name) for text, name in columns.items()])
    return named.filter(F.col(required).isNotNull())


def read_long(spark: SparkSession, path: str, parameter: str) -> DataFrame:
    """(station_id, ts, value) of one parameter from a long CSV file with a fixed schema."""
    rows = spark.read.csv(path, header=True, schema=LONG_SCHEMA)
    return select_parameter(
        rows.select(
            F.col("StationID").alias("station_id"),
            F.col("Date_Time").alias("ts"),
            F.col("Parameter").alias("parameter"),
            F.col("Value").alias("value"),
        ),
        parameter,
    )


def select_parameter(long: DataFrame, parameter: str) -> DataFrame:
    return long.filter((F.col("parameter") == parameter) & F.col("ts").isNotNull()).drop("parameter")


def pivot_parameters(
    long: DataFrame,
    keys: Sequence[str] = ("station_id", "ts"),
    fields: Mapping[str, str] = PARAMETER_FIELDS,
) -> DataFrame:
    """One row per key with a column per known parameter; the fixed list avoids a first pass.

    Repeated readings of a key and parameter keep the greatest value, whatever the row order.
    """
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("parameter") == p, F.col("value"))).alias(f) for p, f in fields.items()]
    )
