"""Population stability and retrain decisions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.scalar import psi_status
from hazeline.operators.aggregate import metric_columns
from hazeline.operators.features import (
    HORIZON_HOURS,
    HOURLY_FEATURES,
    HOURLY_TARGET,
    build_hourly_features,
    trailing_window,
)
from hazeline.operators.gaps import hourly_series
from hazeline.operators.pairs import pair_predictions
from hazeline.plans.quantiles import exact_percentiles
from hazeline.plans.series import KEYS, hour_index
from hazeline.session import stage_table

# Share that replaces an empty bin, and the monitors' thresholds.
EMPTY_SHARE = 1e-4
DAILY_MONITOR = {"window_days": 30, "min_pairs": 7, "mae": 6.0, "psi": 0.2, "bins": 10}
HOURLY_MONITOR = {
    "window_days": 14,
    "lookback_days": 19,
    "min_rows": 168,
    "rmse": 13.0,
    "psi": 0.2,
    "bins": 10,
}
EDGE_PLACES = 9


def two_samples(
    expected: DataFrame, actual: DataFrame, value: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Long form of two samples: (keys, is_actual, value)."""
    side = lambda df, flag: df.select(*keys, F.lit(flag).alias("is_actual"), F.col(value).alias("value"))
    return side(expected, False).unionByName(side(actual, True))


def wide_samples(
    pairs: DataFrame, expected: str, actual: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The same long form from two columns of one row, without scanning it twice."""
    both = F.array(
        F.struct(F.lit(False).alias("is_actual"), F.col(expected).alias("value")),
        F.struct(F.lit(True).alias("is_actual"), F.col(actual).alias("value")),
    )
    return pairs.select(*keys, F.explode(both).alias("_s")).select(*keys, "_s.*")


def _index(counted: DataFrame, keys: Sequence[str], enough: Column) -> DataFrame:
    """Sum of (a - e) ln(a / e) over bins from the per-bin counts `_e` and `_a`."""
    bins = counted.groupBy(*keys, enough.alias("_enough")).agg(
        F.sum("_e").alias("_ne"),
        F.sum("_a").alias("_na"),
        F.collect_list(F.struct(F.col("_e").alias("e"), F.col("_a").alias("a"))).alias("_bins"),
    )
    terms = F.transform(
        "_bins", lambda b: _term(_share(b["e"], F.col("_ne")), _share(b["a"], F.col("_na")))
    )
    total = F.round(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t), 4)
    return bins.select(*keys, F.when(F.col("_enough"), total).otherwise(F.lit(0.0)).alias("psi"))


def _share(count: Column, total: Column) -> Column:
    return F.when(count == 0, F.lit(EMPTY_SHARE)).otherwise(F.try_divide(count, total))


def _term(e: Column, a: Column) -> Column:
    return (a - e) * F.ln(F.try_divide(a, e))


def _edges(percentiles: Column) -> Column:
    return F.array_distinct(F.transform(percentiles, lambda e: F.round(e, EDGE_PLACES)))


def psi(samples: DataFrame, bins: int = 10, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stability index per key over quantile bins of both samples pooled.

    Values and edges are rounded alike, so a value on an edge is never moved by float noise; edges
    are deduplicated; the outer edges are open; fewer than three distinct edges give 0. Groups may
    be of any size.
    """
    rounded = F.round("value", EDGE_PLACES).alias("value")
    rows = samples.filter(F.col("value").isNotNull()).select(*keys, "is_actual", rounded)
    probs = [i / bins for i in range(bins + 1)]
    edges = exact_percentiles(rows, "value", probs, keys).select(*keys, _edges(F.col("q")).alias("_all"))
    inner = F.slice("_all", 2, F.greatest(F.size("_all") - 2, F.lit(0)))
    cut = stage_table(
        edges.select(*keys, (F.size("_all") >= 3).alias("_enough"), inner.alias("_inner")), "edges"
    )
    # one comparison per possible inner edge stays inside generated code
    passed = [F.coalesce((F.get("_inner", F.lit(i)) <= F.col("value")).cast("int"), F.lit(0)) for i in range(bins - 1)]
    bin_of = reduce(lambda a, b: a + b, passed)
    counted = (
        rows.join(cut, list(keys))
        .groupBy(*keys, "_enough", bin_of.alias("_bin"))
        .agg(F.count_if(~F.col("is_actual")).alias("_e"), F.count_if("is_actual").alias("_a"))
    )
    return _index(counted, keys, F.col("_enough"))


def psi_of_arrays(percentiles: Column, expected: Column, actual: Column) -> Column:
    """The same index inside one row, for two short arrays and their pooled percentiles."""
    edges = _edges(percentiles)
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    infinity = F.lit(float("inf"))

    def inside(values: Column, low: Column, high: Column) -> Column:
        return _share(F.size(F.filter(values, lambda v: (v >= low) & (v < high))), F.size(values))

    terms = F.zip_with(
        F.concat(F.array(-infinity), inner),
        F.concat(inner, F.array(infinity)),
        lambda low, high: _term(inside(expected, low, high), inside(actual, low, high)),
    )
    total = F.round(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t), 4)
    return F.when(F.size(edges) < 3, F.lit(0.0)).otherwise(total)


def window_health(pairs: DataFrame, keys: Sequence[str] = KEYS, bins: int = 10) -> DataFrame:
    """n, MAE, RMSE, R2 and PSI of (predicted, actual) pairs per key, in one aggregate.

    For keys whose rows a time window bounds (two weeks of hours, a month of days): the values of
    a key are gathered in its row.
    """
    error = F.col("actual") - F.col("predicted")
    side = lambda flag, value, err: F.struct(
        F.lit(flag).alias("is_actual"), F.col(value).alias("value"), err.alias("error")
    )
    both = F.array(
        side(False, "predicted", error), side(True, "actual", F.lit(None).cast("double"))
    )
    rows = pairs.filter(error.isNotNull()).select(*keys, F.explode(both).alias("s")).select(*keys, "s.*")
    value = F.col("value")
    rounded = F.round(value, EDGE_PLACES)
    gathered = rows.groupBy(*keys).agg(
        F.count("error").alias("n"),
        F.avg(F.abs("error")).alias("_mae"),
        F.avg(F.col("error") * F.col("error")).alias("_mse"),
        F.var_pop(F.when(F.col("is_actual"), value)).alias("_var"),
        F.percentile(rounded, [i / bins for i in range(bins + 1)]).alias("_q"),
        F.collect_list(F.when(~F.col("is_actual"), rounded)).alias("_e"),
        F.collect_list(F.when(F.col("is_actual"), rounded)).alias("_a"),
    )
    metrics = metric_columns(F.col("n"), F.col("_mae"), F.col("_mse"), F.col("_var"))
    index = psi_of_arrays(F.col("_q"), F.col("_e"), F.col("_a"))
    return gathered.select(*keys, "n", *metrics, index.alias("psi"))


def psi_equal_width(
    samples: DataFrame, bins: int = 10, keys: Sequence[str] = KEYS, own_range: bool = False
) -> DataFrame:
    """Documented variant with equal-width bins over the expected sample's range.

    Values outside that range count in the outer bins. `own_range` bins each sample over its own
    range instead, as two independent histograms do.
    """
    rows = samples.filter(F.col("value").isNotNull())
    part = [*keys, "is_actual"] if own_range else list(keys)
    ranged = F.lit(True) if own_range else ~F.col("is_actual")
    spans = stage_table(
        rows.groupBy(*part).agg(
            F.min(F.when(ranged, F.col("value"))).alias("_lo"),
            F.max(F.when(ranged, F.col("value"))).alias("_hi"),
        ),
        "spans",
    )
    place = F.try_divide((F.col("value") - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo"))
    bin_of = F.least(F.greatest(F.coalesce(F.floor(place), F.lit(0)), F.lit(0)), F.lit(bins - 1))
    counted = (
        rows.join(spans, part)
        .groupBy(*keys, bin_of.alias("_bin"))
        .agg(F.count_if(~F.col("is_actual")).alias("_e"), F.count_if("is_actual").alias("_a"))
    )
    return _index(counted, keys, F.lit(True))


def feature_psi(
    expected: DataFrame, actual: DataFrame, features: Sequence[str], bins: int = 10
) -> DataFrame:
    """PSI per station and feature; all features in one plan."""
    long = lambda df, flag: (
        df.select("station", *[F.col(f).cast("double").alias(f) for f in features])
        .unpivot(["station"], list(features), "feature", "value")
        .withColumn("is_actual", F.lit(flag))
    )
    samples = long(expected, False).unionByName(long(actual, True))
    return psi(samples, bins, ["station", "feature"]).withColumn("status", psi_status(F.col("psi")))


def daily_monitor(
    predictions: DataFrame,
    actuals: DataFrame,
    order: Sequence[str],
    stations: DataFrame,
    config: Mapping[str, float] = DAILY_MONITOR,
) -> DataFrame:
    """Latest pairs of the trailing window per station: MAE, PSI and the retrain decision.

    Stations with too few pairs keep null metrics and are never sent to retraining. The last day with a
    pair comes from the keys of both logs alone; only the window after its bound is read with all
    columns, made distinct and joined. Give scans of stored logs.
    """
    days, keys = int(config["window_days"]), ["station", "date"]
    both = predictions.select(*keys).distinct().join(actuals.select(*keys).distinct(), keys)
    last = stage_table(both.groupBy("station").agg(F.max("date").alias("_last")), "last-pairs")
    windowed = lambda log: trailing_window(log, days, "date", last=last)
    recent = pair_predictions(windowed(predictions), windowed(actuals), order)
    health = window_health(recent, bins=int(config["bins"])).select(
        "station", "n", F.col("mae").alias("_mae"), F.col("psi").alias("_psi")
    )
    joined = stations.select("station").distinct().join(health, "station", "left")
    count = F.coalesce("n", F.lit(0)).cast("bigint")
    enough = count >= int(config["min_pairs"])
    mae, index = F.when(enough, F.col("_mae")), F.when(enough, F.col("_psi"))
    mae_bad = F.coalesce(mae > config["mae"], F.lit(False))
    psi_bad = F.coalesce(index > config["psi"], F.lit(False))
    return joined.select(
        "station",
        count.alias("evaluated_pairs"),
        mae.alias("mae"),
        F.lit(float(config["mae"])).alias("mae_threshold"),
        mae_bad.alias("mae_degraded"),
        index.alias("psi"),
        F.lit(float(config["psi"])).alias("psi_threshold"),
        psi_status(index).alias("psi_status"),
        psi_bad.alias("psi_degraded"),
        (mae_bad | psi_bad).alias("needs_retraining"),
    )


def forecast_monitor(
    readings: DataFrame,
    registry: DataFrame,
    stations: DataFrame,
    as_of: str,
    score: Callable[[DataFrame], DataFrame],
    config: Mapping[str, float] = HOURLY_MONITOR,
    inputs: Sequence[str] = HOURLY_FEATURES,
) -> DataFrame:
    """Health of the 24-hour models, all stations in one plan.

    `inputs` are the features that a model must have been trained on.

    `registry` has (station, model_key, train_end, has_file, n_features); `score` adds `predicted`
    to a feature table. Only the lookback days before `as_of` are read, and nothing after it: pass raw
    readings (or a view that takes the bounds), so that both bounds reach the scan.
    """
    day = F.lit(as_of).cast("timestamp_ntz").cast("date")
    since = F.date_sub(day, int(config["lookback_days"])).cast("timestamp_ntz")
    until = F.lit(as_of).cast("timestamp_ntz")
    recent = readings.filter((F.col("ts") >= since) & (F.col("ts") < until) & F.col("pm25").isNotNull())
    hour = hour_index(F.col("ts"))
    hours = recent.groupBy("station").agg((F.max(hour) - F.min(hour) + 1).alias("_hours"))
    # the last feature row is one horizon before the station's last reading
    features = build_hourly_features(hourly_series(recent, last="_last"), keep=["_last"])
    reach = HORIZON_HOURS + 24 * int(config["window_days"])
    window = features.filter(hour >= F.col("_last") - reach).drop("_last")
    scored = score(window).select("station", "predicted", F.col(HOURLY_TARGET).alias("actual"))
    health = window_health(scored, bins=int(config["bins"])).withColumnRenamed("n", "_rows")
    joined = (
        stations.select("station")
        .distinct()
        .join(registry, "station", "left")
        .join(hours, "station", "left")
        .join(health, "station", "left")
    )
    rows = F.coalesce("_rows", F.lit(0))
    blocked = (
        F.when(F.col("model_key").isNull(), "no_model")
        .when(~F.col("has_file"), "missing_onnx")
        .when(
            F.coalesce("_hours", F.lit(0)) < int(config["min_rows"]) + HORIZON_HOURS,
            "insufficient_data",
        )
        .when(rows < int(config["min_rows"]), "insufficient_window")
        .when(F.col("n_features") != len(inputs), "shape_mismatch")
    )
    rmse_bad = F.col("rmse") > config["rmse"]
    psi_bad = F.col("psi") > config["psi"]
    status = F.coalesce(blocked, F.when(rmse_bad | psi_bad, "degraded").otherwise("healthy"))
    judged = joined.withColumn("status", status)
    measured = F.col("status").isin("healthy", "degraded")
    shown = lambda c: F.when(measured, c)
    return judged.select(
        "station",
        "status",
        F.col("status").isin("degraded", "missing_onnx", "shape_mismatch").alias("needs_retraining"),
        shown(F.col("rmse")).alias("rmse"),
        F.lit(float(config["rmse"])).alias("rmse_threshold"),
        shown(rmse_bad).alias("rmse_degraded"),
        shown(F.col("mae")).alias("mae"),
        shown(F.col("psi")).alias("psi"),
        F.lit(float(config["psi"])).alias("psi_threshold"),
        shown(psi_status(F.col("psi"))).alias("psi_status"),
        shown(psi_bad).alias("psi_degraded"),
        shown(rows.cast("bigint")).alias("evaluated_pairs"),
        "model_key",
        "train_end",
    )


def retrain_candidates(monitored: DataFrame, error: str = "rmse") -> DataFrame:
    """Stations to retrain, with the reasons as one text."""
    limit = lambda name: F.format_string(
        f"{name.upper()} %.4f > %.1f", F.col(name), F.col(f"{name}_threshold")
    )
    reasons = F.array_compact(
        F.array(
            F.when(F.col(f"{error}_degraded"), limit(error)),
            F.when(F.col("psi_degraded"), limit("psi")),
        )
    )
    return monitored.filter("needs_retraining").select(
        "station", F.array_join(reasons, ", ").alias("reasons")
    )


def monitor_summary(monitored: DataFrame, stations: DataFrame) -> DataFrame:
    """One display row per station; a station that was not checked is UNKNOWN."""
    text = lambda c: F.coalesce(F.format_string("%.4f", F.col(c)), F.lit("N/A"))
    shown = lambda c: F.when(F.col(c).isNull(), "N/A").otherwise(text(c)).alias(c)
    return stations.select("station").distinct().join(monitored, "station", "left").select(
        "station",
        F.upper(F.coalesce("status", F.lit("unknown"))).alias("status"),
        shown("rmse"),
        shown("mae"),
        shown("psi"),
        F.coalesce("model_key", F.lit("N/A")).alias("model"),
    )


def retrain_decision(
    predictions: DataFrame,
    actuals: DataFrame,
    order: Sequence[str],
    threshold: float = 6.0,
    min_pairs: int = 7,
) -> DataFrame:
    """MAE over all matched pairs per station against the threshold, with the reason."""
    stats = (
        pair_predictions(predictions, actuals, order)
        .groupBy("station")
        .agg(
            F.count("*").alias("evaluated_pairs"),
            F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("_mae"),
        )
    )
    enough = F.col("evaluated_pairs") >= min_pairs
    over = enough & (F.col("_mae") > threshold)
    reason = (
        F.when(~enough, "not_enough_pairs").when(over, "mae_above_threshold").otherwise("healthy")
    )
    return stats.select(
        "station",
        "evaluated_pairs",
        F.when(enough, F.round("_mae", 4)).alias("mae"),
        F.lit(float(threshold)).alias("threshold"),
        over.alias("retrain_triggered"),
        reason.alias("reason"),
    )


def monitoring_trend(log: DataFrame, order: str = "checked_at", keys: Sequence[str] = KEYS) -> DataFrame:
    """Metric series with thresholds, band of the stability index and retrain events."""
    return log.select(
        *keys,
        order,
        "mae",
        F.lit(DAILY_MONITOR["mae"]).alias("mae_threshold"),
        "psi",
        psi_status(F.col("psi")).alias("psi_status"),
        ((F.col("mae") > DAILY_MONITOR["mae"]) | (F.col("psi") > DAILY_MONITOR["psi"])).alias(
            "retrain_event"
        ),
    )
