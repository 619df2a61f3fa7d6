"""Sensor-shaped views over the star-schema test tables.

These views give every operator real input: hourly and raw readings from `events`, daily readings
from `orders`, long parameter rows from `lineitem`, station names from `supplier` and `nation`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.plans.series import hour_floor, over_chunks, positioned
from hazeline.session import stage_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def price() -> Column:
    """Order price in thousands with three decimals, 1 to 500."""
    return F.floor("o_totalprice") / 1000


def hourly_readings(
    spark: SparkSession, sf_dir: str, station: str = "event_type", since: str | None = None, until: str | None = None
) -> DataFrame:
    """(station, ts, pm25): the hourly maximum, which does not depend on row order.

    `since` and `until` (exclusive) are whole hours; they bound the raw times, so the scan skips the rest.
    """
    events = table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return events.groupBy(F.col(station).alias("station"), hour_floor(F.col("ts")).alias("ts")).agg(
        F.max("value").alias("pm25")
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: (event_id, station, ts, pm25, pm10); pm10 comes from the JSON field k."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("event_type").alias("station"),
        "ts",
        F.col("value").alias("pm25"),
        F.get_json_object("props", "$.k").cast("double").alias("pm10"),
    )


def gappy_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily readings with missing values: pm25 is masked where the order status is pending."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("station"), F.col("o_orderdate").cast("date").alias("date")
    ).agg(F.max(F.when(F.col("o_orderstatus") != "P", price())).alias("pm25"))


def daily_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, date, pm25): the daily maximum order price."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("station"), F.col("o_orderdate").cast("date").alias("date")
    ).agg(F.max(price()).alias("pm25"))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several log rows per (station, date): each order predicts its own day, in thousands."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("station"),
        F.date_add(F.col("o_orderdate").cast("date"), 1).alias("date"),
        price().alias("predicted"),
        F.col("o_orderkey").alias("entry"),
    )


def actual_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several log rows per (station, date); the highest entry number is the latest."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("station"),
        F.col("o_orderdate").cast("date").alias("date"),
        price().alias("actual"),
        F.col("o_orderkey").alias("entry"),
    )


def station_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station_id, station_name, station_name_en) from suppliers and their nations, as a stored
    table: its size is known, so joins with it are broadcast only while it is small."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    names = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        F.col("n_name").alias("station_name_en"),
    )
    return stage_table(names, "station-names")


def long_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station_id, ts, parameter, value) from the line items' quantity, discount and tax."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("PM2.5"),
        F.col("l_discount").alias("RH"),
        F.col("l_tax").alias("WS"),
    ).unpivot(["station_id", "ts"], [F.col("`PM2.5`"), "RH", "WS"], "parameter", "value")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def wide_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exported sheet: text cells, one column per station, 'n/a' cells and a summary row."""
    daily = daily_readings(spark, sf_dir)
    cells = lambda df: [
        F.coalesce(
            F.max(F.when(F.col("station") == s, F.col("pm25"))).cast("string"), F.lit("n/a")
        ).alias(s)
        for s in PRIORITIES
    ]
    rows = daily.groupBy(F.col("date").cast("string").alias("Date")).agg(*cells(daily))
    return rows.unionByName(daily.groupBy(F.lit("Maximum").alias("Date")).agg(*cells(daily)))


def headerless_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station list below a title and a header row; stations in debt have no id."""
    supplier = table(spark, sf_dir, "supplier")
    cells = "row_no bigint, c0 string, c1 string, c2 string, c3 string"
    top = spark.createDataFrame(
        [
            (0, "Station list", None, None, None),
            (1, None, None, None, None),
            (2, "No", "Station", "Name", "Detail"),
        ],
        cells,
    )
    rows = supplier.select(
        (F.col("s_suppkey") + 3).alias("row_no"),
        F.col("s_suppkey").cast("string").alias("c0"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S"), F.col("s_suppkey"))).alias("c1"),
        F.col("s_name").alias("c2"),
        F.col("s_nationkey").cast("string").alias("c3"),
    )
    return top.unionByName(rows)


def snapshot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payload_id, body): provider JSON made from each event, with an unknown parameter and a
    dash instead of small second measures."""
    events = table(spark, sf_dir, "events")
    local = F.col("ts") + F.make_dt_interval(hours=F.lit(7))
    time = F.format_string(
        "%02d/%02d/%d %02d:%02d",
        F.dayofmonth(local),
        F.month(local),
        F.year(local) + 543,
        F.hour(local),
        F.minute(local),
    )
    k = F.get_json_object("props", "$.k").cast("int")
    entry = lambda alias, name: F.struct(
        F.lit(alias).alias("Alias"),
        F.col("user_id").cast("int").alias("MeasIndex"),
        F.lit(name).alias("ShortName"),
    )
    row = F.create_map(
        *[F.lit("Date_Time"), time],
        *[F.lit("a1"), F.col("value").cast("string")],
        *[F.lit("a2"), F.when(k < 10, "-").otherwise(k.cast("string"))],
        *[F.lit("a3"), F.lit("1")],
    )
    body = F.struct(
        F.array(entry("a1", "PM2.5"), entry("a2", "PM10"), entry("a3", "Noise")).alias("arrParameter"),
        F.array(row).alias("arrData"),
    )
    return events.select(F.col("event_id").alias("payload_id"), F.to_json(body).alias("body"))


def daily_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(payload_id, body): one payload per day with a row per hour, all stations that reported and six
    measures each. Every alias is first listed for another station and measure.

    A body is put together from texts: those of a station's hour, then an hour's, then the day's.
    """
    events = table(spark, sf_dir, "events")
    hour = hour_floor(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("int")
    sums = {
        "p": F.max("value").cast("string"), "q": F.max(k).cast("string"), "t": F.min(k).cast("string"),
        "h": F.count(F.lit(1)).cast("string"), "s": F.when(F.min(k) >= 10, F.min(k).cast("string")).otherwise("-"), "d": F.lit(""),
    }
    hours = events.groupBy("user_id", hour.alias("at")).agg(*[c.alias(n) for n, c in sums.items()])
    day = F.unix_date(F.col("at").cast("date")).cast("bigint").alias("payload_id")
    inside = lambda text: F.substring(text, F.lit(2), F.length(text) - 2)
    cells = F.create_map(*[c for n in sums for c in (F.concat(F.lit(n), "user_id"), F.col(n))])
    listed = hours.select("at", inside(F.to_json(cells)).alias("cells"))
    local = F.col("at") + F.make_dt_interval(hours=F.lit(7))
    time = F.format_string("%02d/%02d/%d %02d:00", F.dayofmonth(local), F.month(local), F.year(local) + 543, F.hour(local))
    rows = listed.groupBy("at").agg(F.array_join(F.collect_list("cells"), ",").alias("cells")).select(
        day, F.concat(F.lit('{"Date_Time":"'), time, F.lit('",'), "cells", F.lit("}")).alias("row"), F.lit(None).cast("bigint").alias("user")
    )
    users = hours.select(day, F.lit(None).cast("string").alias("row"), F.col("user_id").alias("user")).distinct()
    names = {"p": "PM2.5", "q": "PM10", "t": "Temp", "h": "RH", "s": "WS", "d": "WD"}
    entry = lambda n, user, name: F.struct(
        F.concat(F.lit(n), user).alias("Alias"), user.cast("int").alias("MeasIndex"), F.lit(name).alias("ShortName")
    )
    entries = lambda wrong: F.array_join(F.transform("users", lambda u: inside(F.to_json(F.array(*[
        entry(n, u, "PM10" if n == "p" else "PM2.5") if wrong else entry(n, u, name) for n, name in names.items()
    ])))), ",")
    days = rows.unionAll(users).groupBy("payload_id").agg(
        F.collect_list("row").alias("rows"), F.collect_list("user").alias("users")
    )
    return days.select("payload_id", F.concat(
        F.lit('{"arrParameter":['), entries(True), F.lit(","), entries(False),
        F.lit('],"arrData":['), F.array_join("rows", ","), F.lit("]}"),
    ).alias("body"))


def history_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request, history): for each station-day the last 15 readings, a little raised so that some
    leave the accepted range."""
    numbered = positioned(daily_readings(spark, sf_dir), "date", pos="_pos")
    reading = F.struct("date", (F.col("pm25") * 1.02).alias("pm25"))
    wide = over_chunks(
        numbered, lambda w: {"history": F.collect_list(reading).over(w.rowsBetween(-14, 0))}, "_pos", back=14
    )
    return wide.select(F.struct("station", "date").alias("request"), "history")


def event_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station list of the events plus one station that never reports."""
    seen = table(spark, sf_dir, "events").select(F.col("event_type").alias("station")).distinct()
    return seen.unionByName(spark.createDataFrame([("offline",)], "station string"))
