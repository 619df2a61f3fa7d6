"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "hazeline", **conf: str) -> SparkSession:
    """Session with UTC time, AQE and skew handling; `conf` uses `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # grids and windows grow after a shuffle, so small shuffles stay spread over the cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # stream state (open windows, recent keys) lives on disk, not on the executor heap
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared `spark.checkpoint.dir`.

    Only a single-machine session may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="hazeline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str, **options: object) -> DataFrame:
    """Write a result once to the shared folder and read it back.

    Three uses: it cuts the lineage where several jobs read a result; the copy survives lost
    executors; and Spark knows the true size of the copy, so a join with it is a broadcast only
    below the broadcast threshold and a sort-merge join with skew handling beyond it. Without the
    copy, Spark would shuffle a large table by station just to meet one row per station. `options` are those of the Parquet writer.
    """
    path = work_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
