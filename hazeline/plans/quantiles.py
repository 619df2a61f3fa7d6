"""Exact percentiles without holding a group in one task.

The built-in `percentile` keeps every distinct value of a group in memory. Here a mergeable sketch
first brackets each wanted rank. Brackets cut the value range into ordered cells; cells outside
every bracket are only counted, and the few values inside a bracket are ranked exactly. Linear
interpolation between neighbouring ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.session import stage_table

SKETCH_ACCURACY = 10_000


def exact_percentiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str]
) -> DataFrame:
    """One row per key: `q`, the percentiles in the order of `probs`, and `n`, the value count.

    The first pass (the sketch) runs when this is called. `df` is read twice, so give a stored table
    where its plan is expensive.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    margin = 3.0 / SKETCH_ACCURACY  # sketch error is at most 1 / SKETCH_ACCURACY
    lows = [max(p - margin, 0.0) for p in probs]
    highs = [min(p + margin, 1.0) for p in probs]
    sketch = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.percentile_approx("_v", lows, SKETCH_ACCURACY).alias("_low"),
        F.percentile_approx("_v", highs, SKETCH_ACCURACY).alias("_high"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    # groups no larger than the sketch, and brackets at the ends, open to the true extremes
    small = F.col("n") <= SKETCH_ACCURACY
    spots = range(len(probs))
    brackets = stage_table(
        sketch.select(
            *keys,
            "n",
            *[
                F.when(small | F.lit(lows[i] <= 0), F.col("_min"))
                .otherwise(F.col("_low")[i])
                .alias(f"_l{i}")
                for i in spots
            ],
            *[
                F.when(small | F.lit(highs[i] >= 1), F.col("_max"))
                .otherwise(F.col("_high")[i])
                .alias(f"_h{i}")
                for i in spots
            ],
        ),
        "brackets",
    )
    started = reduce(lambda a, b: a + b, [(F.col("_v") >= F.col(f"_l{i}")).cast("int") for i in spots])
    ended = reduce(lambda a, b: a + b, [(F.col("_v") > F.col(f"_h{i}")).cast("int") for i in spots])
    counted = (
        rows.join(brackets, list(keys))
        .select(*keys, "n", "_v", started.alias("_s"), ended.alias("_e"))
        .groupBy(
            *keys,
            "n",
            (F.col("_s") + F.col("_e")).alias("_cell"),
            F.when(F.col("_s") > F.col("_e"), F.col("_v")).alias("_at"),
        )
        .agg(F.count("*").alias("_c"))
    )
    by_cell = (
        Window.partitionBy(*keys)
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = counted.groupBy(*keys, "_cell").agg(F.sum("_c").alias("_size"))
    offsets = cells.select(
        *keys, "_cell", F.coalesce(F.sum("_size").over(by_cell), F.lit(0)).alias("_before")
    )
    by_value = (
        Window.partitionBy(*keys, "_cell")
        .orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # a cell outside the brackets is one row without a value; leaving it in keeps both uses of
    # `counted` identical, so Spark reuses the shuffle
    ranked = counted.join(offsets, [*keys, "_cell"]).withColumn(
        "_end", F.col("_before") + F.sum("_c").over(by_value)
    )
    begin, end = F.col("_end") - F.col("_c"), F.col("_end")

    def at_rank(rank):
        return F.max(F.when((begin <= rank) & (rank < end), F.col("_at")))

    rank = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    picked = ranked.groupBy(*keys, "n").agg(
        *[at_rank(F.floor(rank[i])).alias(f"_lo{i}") for i in spots],
        *[at_rank(F.ceil(rank[i])).alias(f"_hi{i}") for i in spots],
    )
    q = []
    for i in spots:
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        exact = lo + (hi - lo) * (rank[i] - F.floor(rank[i]))
        missing = F.raise_error(F.lit("rank outside its bracket")).cast("double")
        q.append(F.when(exact.isNull(), missing).otherwise(exact))
    return picked.select(*keys, F.array(*q).alias("q"), "n")
