"""Day tables that change all at once.

A change writes its new day folders beside the old ones and then a manifest, the list of folders
that make up the table from then on. The manifest's success mark is the only thing that readers look at:
before it is there they see the table as it was, after it the whole change, days that became empty
included. A change that fails half-way leaves files that nothing points to. A table has one writer
at a time; one that finds a newer version than it started from raises.

Only the days that a change touches are read and written. The manifest has a row per day and
folder, so its size goes with the days, not with the rows; `compact` brings days that were appended
to back to one folder each.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from hazeline.operators.upsert import delete_date_range, new_rows, replace_range, replace_range_counts, upsert
from hazeline.session import stage_table
from hazeline.sources.tables import touched_days, write_by_day

MANIFEST = "day date, folder string"
READING_KEYS, PREDICTION_KEYS = ("station", "ts"), ("prediction_date", "station")


class StaleVersion(RuntimeError):
    """The table changed between the read and the commit of a change."""


def _entries(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in system.listStatus(path)] if system.exists(path) else []


def current_version(spark: SparkSession, path: str) -> int:
    """The newest complete version, 0 for a table that has none."""
    found = sorted((int(n) for n in _entries(spark, f"{path}/versions") if n.isdigit()), reverse=True)
    return next((n for n in found if "_SUCCESS" in _entries(spark, f"{path}/versions/{n:012d}")), 0)


def manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/versions/{version:012d}")


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, days: Sequence | None = None,
    since: str | None = None, until: str | None = None, version: int | None = None,
) -> DataFrame:
    """The rows of a version, with `day`; only folders of the wanted days are listed.

    `since` and `until` are inclusive days. A table without rows needs `schema` (without `day`).
    """
    version = current_version(spark, path) if version is None else version
    listed = manifest(spark, path, version)
    if days is not None:
        listed = listed.filter(F.col("day").isin(list(days)) if days else F.lit(False))
    if since is not None:
        listed = listed.filter(F.col("day") >= F.lit(since).cast("date"))
    if until is not None:
        listed = listed.filter(F.col("day") <= F.lit(until).cast("date"))
    folders = [f"{path}/{r['folder']}" for r in listed.select("folder").distinct().collect()]
    if schema is not None:
        schema = StructType([*schema.fields, StructField("day", DateType())])
        if not folders:
            return spark.createDataFrame([], schema)
    if not folders:
        first = manifest(spark, path, version).first()
        if first is None:
            raise ValueError(f"{path} has no rows; give a schema")
        return read_table(spark, path, days=[first["day"]], version=version).limit(0)
    reader = spark.read.option("basePath", f"{path}/data")
    return (reader if schema is None else reader.schema(schema)).parquet(*folders).drop("commit")


def write_change(spark: SparkSession, path: str, content: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    """First step of a change: the new day folders, which no reader sees yet. Returns their manifest rows."""
    commit = f"data/commit={uuid.uuid4().hex}"
    write_by_day(content, f"{path}/{commit}", order=order, keys=[k for k in keys if k != order])
    days = [n.removeprefix("day=") for n in _entries(spark, f"{path}/{commit}") if n.startswith("day=")]
    rows = [(d, f"{commit}/day={d}") for d in days]
    return spark.createDataFrame(rows, "day string, folder string").select(F.col("day").cast("date"), "folder")


def commit_change(spark: SparkSession, path: str, base: int, fresh: DataFrame, replaced: Sequence) -> int:
    """Second step: the manifest in which `fresh` stands for the `replaced` days."""
    if current_version(spark, path) != base:
        raise StaleVersion(f"{path} is at version {current_version(spark, path)}, the change began at {base}")
    old = manifest(spark, path, base)
    kept = old.filter(~F.col("day").isin(list(replaced))) if replaced else old
    kept.unionByName(fresh).coalesce(1).write.parquet(f"{path}/versions/{base + 1:012d}")
    return base + 1


def _change(spark: SparkSession, path: str, base: int, content: DataFrame, replaced: Sequence, order: str, keys) -> int:
    return commit_change(spark, path, base, write_change(spark, path, content, order, keys), replaced)


def insert_ignore_table(
    spark: SparkSession, path: str, batch: DataFrame, order: Sequence[str], keys: Sequence[str] = READING_KEYS
) -> int:
    """Append the rows whose key is not stored yet; returns their number."""
    days = touched_days(batch, keys=keys)
    if not days:
        return 0
    base = current_version(spark, path)
    target = read_table(spark, path, batch.schema, days, version=base)
    fresh = stage_table(new_rows(target, batch, order, keys), "new-rows")
    added = fresh.count()
    if added:
        _change(spark, path, base, fresh, [], keys[-1], keys)
    return added


def replace_range_table(
    spark: SparkSession, path: str, batch: DataFrame, start: Column, end: Column, order: Sequence[str],
    stations: Sequence | None = None, keys: Sequence[str] = READING_KEYS,
) -> DataFrame:
    """Delete [start, end) of the stations, insert-ignore the batch; one row of deleted, inserted
    and duplicate counts. Running it twice gives the same table."""
    base, asked = current_version(spark, path), touched_days(batch, keys=keys)
    listed = manifest(spark, path, base).select("day").distinct()
    in_days = (F.col("day") >= start.cast("date")) & (F.col("day") <= end.cast("date"))
    days = [r["day"] for r in listed.filter(in_days | F.col("day").isin(asked)).collect()]
    affected = read_table(spark, path, batch.schema, days, version=base).drop("day")
    counts = stage_table(replace_range_counts(affected, batch, start, end, order, stations, keys), "replace-counts")
    content = stage_table(replace_range(affected, batch, start, end, order, stations, keys), "replaced-days")
    _change(spark, path, base, content, days, keys[-1], keys)
    return counts


def upsert_table(
    spark: SparkSession, path: str, batch: DataFrame, order: Sequence[str], keys: Sequence[str] = PREDICTION_KEYS,
    day: str = "prediction_date",
) -> None:
    """Batch rows replace stored rows of the same key."""
    days = touched_days(batch, day, keys)
    if not days:
        return
    base = current_version(spark, path)
    target = read_table(spark, path, batch.schema, days, version=base).drop("day")
    content = stage_table(upsert(target, batch, order, keys), "upserted-days")
    _change(spark, path, base, content, days, day, keys)


def delete_dates_table(
    spark: SparkSession, path: str, first: str, last: str, stations: Sequence | None = None,
    keys: Sequence[str] = PREDICTION_KEYS, day: str = "prediction_date",
) -> None:
    """Delete the dates from `first` to `last` inclusive, optionally of some stations."""
    base = current_version(spark, path)
    bounds = F.lit(first).cast("date"), F.lit(last).cast("date")
    listed = manifest(spark, path, base).filter(F.col("day").between(*bounds)).select("day").distinct()
    days = [r["day"] for r in listed.collect()]
    if days:
        stored = read_table(spark, path, days=days, version=base).drop("day")
        content = stage_table(delete_date_range(stored, *bounds, stations, day), "kept-days")
        _change(spark, path, base, content, days, day, keys)


def compact(spark: SparkSession, path: str, order: str = "ts", keys: Sequence[str] = READING_KEYS) -> int:
    """Rewrite the days that lie in several folders; returns how many there were."""
    base = current_version(spark, path)
    many = manifest(spark, path, base).groupBy("day").count().filter("count > 1")
    days = [r["day"] for r in many.collect()]
    if days:
        content = stage_table(read_table(spark, path, days=days, version=base).drop("day"), "compacted-days")
        _change(spark, path, base, content, days, order, keys)
    return len(days)
