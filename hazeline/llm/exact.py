"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by text digest. A delivery is reduced to its distinct
digests, anti-joined with the index by sort-merge (the index side is read in its buckets and is
not shuffled) and the survivors are appended to the same buckets. The verdicts need only 32-byte
digests in their shuffles; `drop_copies` also moves whole rows once, to their verdicts.

The number of buckets follows the first delivery (`BUCKET_ROWS` rows each) and is kept with the table.
Every delivery adds a file per bucket; `compact_index` writes them anew as one sorted file each.

Equal means: the same text after lower-casing A-Z. Null text equals empty text. Inside one
delivery the row with the largest doc_id stays (null is the smallest); of rows that repeat doc_id
and text, exactly one stays. Across deliveries the row indexed first stays. An empty delivery
changes nothing. Extra columns of the input are not read.

A delivery that is run again after a failure finds its digests in the index and appends nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.common import id_text, lower_ascii, text_digest, whole
from hazeline.session import stage_table, work_dir

BUCKET_ROWS = 1 << 20
LEAST_BUCKETS = 8


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_id, doc_id, digest), written once so that the row ids hold."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(key).cast("long").alias("doc_id"),
        text_digest(lower_ascii(whole(F.col(text)))).alias("digest"),
    )
    return stage_table(rows, "digests")


def index_name(path: str) -> str:
    return f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"


def open_index(spark: SparkSession, path: str, rows: int = 0) -> str:
    """Name of the index table at `path`; creates it empty, for deliveries of about `rows`, where there
    is none."""
    name, buckets = index_name(path), max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, keep_row BIGINT, delivery STRING) USING parquet "
        f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return name


def index_buckets(spark: SparkSession, path: str) -> int:
    listed = spark.sql(f"DESCRIBE TABLE EXTENDED {index_name(path)}").filter("col_name = 'Num Buckets'")
    return int(listed.first()["data_type"])


def append(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """`rows` into the buckets of the index, one sorted file per bucket."""
    name, buckets = index_name(path), index_buckets(spark, path)
    rows.repartition(buckets, "digest").write.mode("append").format("parquet").option("path", path).bucketBy(
        buckets, "digest"
    ).sortBy("digest").saveAsTable(name)
    spark.catalog.refreshTable(name)


def compact_index(spark: SparkSession, path: str, new_path: str, rows: int | None = None) -> None:
    """A copy of the index at `new_path` with one sorted file per bucket, in as many buckets as its
    rows need now; readers move over when it is complete."""
    old = spark.table(open_index(spark, path))
    open_index(spark, new_path, old.count() if rows is None else rows)
    append(spark, new_path, old)


def add_delivery(spark: SparkSession, path: str, rows: DataFrame, delivery: str = "") -> None:
    """Append the digests of `rows` (from `digests`) that the index does not hold yet.

    Row ids restart in each staged delivery, so `keep_row` holds together with `delivery` only.
    """
    name = open_index(spark, path, rows.count())
    best = F.max(F.struct("doc_id", "row_id"))
    groups = rows.groupBy("digest").agg(best.alias("best")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"),
        F.lit(delivery).alias("delivery"),
    )
    known = spark.table(name).select("digest").hint("merge")
    append(spark, path, groups.join(known, "digest", "left_anti"))


def resolve(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """(row_id, doc_id, digest, keep_id, keep_row, delivery, group_size) for every row of `rows`.

    The groups are staged, so that both sides of the last join are shuffled for it and a group
    with a third of all rows can be split.
    """
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = stage_table(sizes.join(spark.table(open_index(spark, path)), "digest"), "digest-groups")
    return rows.join(groups, "digest")


def deduplicated(docs: DataFrame, deliveries: int = 2) -> DataFrame:
    """One row per row of `docs`: which row of its group stays.

    The table is fed to a new index in deliveries of descending doc_id, as an archive that is
    loaded newest first, so the row with the largest doc_id of all stays.
    """
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "digest-index")
    rows = digests(docs)
    shares = [F.lit(i / deliveries) for i in range(1, deliveries)]
    cuts = rows.select(F.percentile_approx("doc_id", F.array(*shares))).first()[0] if shares else None
    bounds = sorted(set(cuts or []), reverse=True)
    below = F.lit(True)
    for bound in bounds:
        add_delivery(spark, path, rows.filter(below & (F.col("doc_id") >= bound)))
        below = F.coalesce(F.col("doc_id") < bound, F.lit(True))
    add_delivery(spark, path, rows.filter(below))
    return resolve(spark, path, rows).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, delivery: str = ""
) -> DataFrame:
    """`docs` without the rows that the index does not keep; all columns stay as they are.

    With `path`, the index there is used and extended: rows whose text an earlier delivery holds are
    dropped too. `delivery` then names this one; a run again under its name gives the same rows.
    Without `path` the index is new.
    """
    if path is not None and not delivery:
        raise ValueError("a delivery to an existing index needs a name")
    spark = docs.sparkSession
    path = path or work_dir(spark, "digest-index")
    rows = digests(docs, key, text)
    add_delivery(spark, path, rows, delivery=delivery)
    kept = (F.col("delivery") == delivery) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    lost = resolve(spark, path, rows).filter(~kept)
    lost = lost.select(F.concat("digest", id_text(F.col("doc_id")).cast("binary")).alias("_lost_key")).distinct()
    own = F.concat(
        text_digest(lower_ascii(whole(F.col(f"rec.`{text}`")))),
        id_text(F.col(f"rec.`{key}`").cast("long")).cast("binary"),
    )
    # one shuffle on the key serves the anti-join and the choice among rows that repeat an id and text
    left = docs.select(F.struct("*").alias("rec")).select("rec", own.alias("_own_key"))
    kept = left.join(lost, F.col("_own_key") == F.col("_lost_key"), "left_anti").dropDuplicates(["_own_key"])
    return kept.select("rec.*")
