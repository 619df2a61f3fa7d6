"""Mixing sources to target weights by systematic sampling.

A document's expected copies are target / size of its source, the same for all documents of a
source. The documents of a source are put in one fixed order, their expected copies are summed up
along it from one random offset, and a document is emitted once for every whole number that its
step crosses. The order goes by size first, so every stretch of sizes gives its share and the
words taken come near the target.

The running sum is never one task per source: the order is cut into segments (size class, hash
bucket); counts of segments are summed along the class and along the source in small windows, and
rows are numbered inside segments only.

Sizes are words; null and empty texts have size 0 and may be emitted (they take no words). Sources
are ordered by code point with null as a source of its own at the end. Ties in size are ordered by
md5 of id and text, then the id; rows that repeat both are interchangeable.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import id_text, whole, word_count
from hazeline.session import stage_table

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2.0
SEED = "mix"


def size_class(size: Column) -> Column:
    """Sizes with the same bit length and the same three leading bits share a class."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 3))


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's random offset in [0, 1)."""
    text = F.concat(F.lit(seed), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_repeat: float = MAX_REPEAT,
) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Weights repeat along the sources in code-point order. A target stops at `max_repeat` times the
    source's size and the excess goes to the others by weight. Sorted by cap over weight, the
    capped sources are the first ones, so running sums find the level in one pass. The windows
    have no partition: there is one row per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    turn = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))).cast("int")
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(listed, turn + 1).cast("long").alias("weight"),
        (F.col("source_size") * max_repeat).alias("cap"),
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    levels = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * total_share - F.coalesce(F.sum("cap").over(before), none)).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), none)).alias("open_weight"),
    ).select("*", (F.col("left") / F.col("open_weight")).alias("level"))
    is_open = F.col("cap") / F.col("weight") > F.col("level")
    level = F.min(F.when(is_open, F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("at")))).over(everything)
    capped = levels.select("*", is_open.alias("is_open"), level.alias("first_open"))
    return capped.select(
        "source",
        "source_size",
        F.when(F.col("is_open"), F.col("weight") * F.col("first_open.at")).otherwise(F.col("cap")).alias("target"),
    )


def mixed(
    docs: DataFrame, carry: Sequence[str], key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """(rec, size, source, source_size, target, copies): `rec` holds the columns in `carry`.

    One shuffle of the rows, on (source, class, bucket).
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rec"),
        F.col(key).alias("key"),
        F.col(source).cast("string").alias("source"),
        word_count(whole(F.col(text))).alias("size"),
        # the text keeps rows without an id, or with one repeated id, from meeting in one bucket
        F.md5(F.concat_ws("|", id_text(F.col(key)), F.md5(whole(F.col(text)).cast("binary"))).cast("binary")).alias("dice"),
    ).select("*", size_class(F.col("size")).alias("class"), F.substring("dice", 1, 2).alias("bucket"))
    segment = ("source", "class", "bucket")
    counts = stage_table(
        rows.groupBy(*segment).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-segments"
    )
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")))
    classes = counts.groupBy("source", "class").agg(F.sum("n").alias("class_n"))
    earlier = lambda order, *by: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = lambda column, window: F.coalesce(F.sum(column).over(window), F.lit(0))
    class_starts = classes.select("source", "class", start("class_n", earlier("class", "source")).alias("class_start"))
    starts = counts.select(*segment, start("n", earlier("bucket", "source", "class")).alias("bucket_start"))
    same = lambda left, right, names: [left[c].eqNullSafe(right[c]) for c in names]
    located = starts.join(class_starts, same(starts, class_starts, ("source", "class"))).select(
        starts["source"], starts["class"], "bucket", (F.col("class_start") + F.col("bucket_start")).alias("start")
    )
    aimed = located.join(targets, located["source"].eqNullSafe(targets["source"])).select(
        *[located[c].alias(f"s_{c}") for c in segment], "start", "source_size", "target"
    )
    aimed = stage_table(aimed, "mix-starts")
    place = Window.partitionBy(*segment).orderBy("size", "dice", F.col("key").asc_nulls_first())
    numbered = rows.select("rec", *segment, "size", F.row_number().over(place).alias("place"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("start") + F.col("place")
    crossed = lambda n: F.floor(offset(F.col("source")) + F.col("rate") * n)
    copies = F.least(crossed(F.col("at")) - crossed(F.col("at") - 1), F.ceil("rate"))
    return (
        numbered.join(aimed, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in segment])
        .select("rec", "size", "source", "source_size", "target", rate.alias("rate"), at.alias("at"))
        .select("rec", "size", "source", "source_size", "target", copies.cast("long").alias("copies"))
    )


def mix(docs: DataFrame, **names: str) -> DataFrame:
    """The mix itself: every row of `docs` as often as the sampling emits it, same columns."""
    rows = mixed(docs, docs.columns, **names)
    emitted = rows.filter(F.col("copies") > 0).select("rec", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return emitted.select("rec.*")
