"""The hourly training run: gate, fit, score, choose and promote, for all stations in one go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.features import HOURLY_FEATURES, HOURLY_TARGET
from hazeline.operators.fit import (
    HOURLY_RIDGE_ALPHAS,
    fit_linear,
    predict_linear,
    ridge_grid_search,
)
from hazeline.operators.model import champion, promote, score_candidates, time_folds
from hazeline.operators.trees import BOOSTED, FOREST, TREE_COLUMNS, TREE_LIST, TreeSpec, score_trees, tree_search
from hazeline.operators.validate import keep_sized, size_gate
from hazeline.session import stage_table

# Rows a station needs to be trained, and the folds of its search.
MIN_ROWS: Mapping[str, int] = {"train": 200, "test": 48}
SEARCH_FOLDS = 3


def train_linear_models(
    split: DataFrame,
    production: DataFrame,
    features: Sequence[str] = HOURLY_FEATURES,
    target: str = HOURLY_TARGET,
    alphas: Sequence[float] = HOURLY_RIDGE_ALPHAS,
    min_rows: Mapping[str, int] = MIN_ROWS,
    metric: str = "rmse",
    margin: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """Fit linear and ridge on the train rows, score both on the test rows, and judge the better.

    `split` has (station, ts, features, target, split) and is read several times: give a stored
    table. `production` has (station, rmse, mae) of the running models. Returns the promotion
    result per station and the weights per (station, model); stations below `min_rows` are left
    out of both.
    """
    rows = keep_sized(split, size_gate(split, min_rows))
    train, test = (rows.filter(F.col("split") == name) for name in ("train", "test"))
    blocked = stage_table(time_folds(train, SEARCH_FOLDS), "train-folds")
    ridge = ridge_grid_search(blocked, features, target, alphas, SEARCH_FOLDS)
    weights = stage_table(
        fit_linear(train, features, target)
        .withColumn("model", F.lit("linear"))
        .unionByName(
            ridge.filter(F.col("rank") == 1).select("station", "weights", F.lit("ridge").alias("model"))
        ),
        "weights",
    )
    scored = None
    for name in ("linear", "ridge"):
        mine = weights.filter(F.col("model") == name).select("station", "weights")
        part = predict_linear(test, mine, features).select(
            "station", F.col(target).alias("actual"), F.lit(name).alias("model"), "predicted"
        )
        scored = part if scored is None else scored.unionByName(part)
    best = champion(score_candidates(scored), metric)
    return promote(best, production, margin), weights


# models as data: one row per station and kind, weights or tree nodes inside
KINDS = ("linear", "ridge", "forest", "boosted")


def train_models(
    train: DataFrame, features: Sequence[str] = HOURLY_FEATURES, target: str = HOURLY_TARGET, kinds: Sequence[str] = KINDS,
    alphas: Sequence[float] = HOURLY_RIDGE_ALPHAS, forest: TreeSpec = FOREST, boosted: TreeSpec = BOOSTED, order: str = "ts",
) -> DataFrame:
    """(station, model_key, n_features, train_start, train_end, weights, trees) of every kind, stored.

    Ridge, forest and boosted trees are searched over time folds and refitted on all rows of
    `train`, which is read several times: give a stored table.
    """
    blocked = stage_table(time_folds(train, SEARCH_FOLDS, order), "train-folds") if set(kinds) - {"linear"} else None
    spans = train.groupBy("station").agg(
        F.min(order).cast("date").alias("train_start"), F.max(order).cast("date").alias("train_end")
    )
    none = F.lit(None).cast("array<double>")
    parts = []
    for kind in kinds:
        if kind in ("linear", "ridge"):
            found = fit_linear(train, features, target) if kind == "linear" else ridge_grid_search(
                blocked, features, target, alphas, SEARCH_FOLDS
            ).filter(F.col("rank") == 1)
            part = found.select("station", "weights").withColumn("trees", F.lit(None).cast(TREE_LIST))
        else:
            _, best = tree_search(blocked, features, target, forest if kind == "forest" else boosted, SEARCH_FOLDS, order)
            listed = F.collect_list(F.struct(*TREE_COLUMNS)).cast(TREE_LIST)
            part = best.groupBy("station").agg(listed.alias("trees")).withColumn("weights", none)
        parts.append(part.select("station", F.lit(kind).alias("model_key"), "weights", "trees"))
    models = reduce(DataFrame.unionByName, parts).join(spans, "station")
    return stage_table(
        models.select(
            "station", "model_key", F.lit(len(features)).alias("n_features"), "train_start", "train_end", "weights", "trees"
        ),
        "trained-models",
    )


def score_models(
    rows: DataFrame, models: DataFrame, features: Sequence[str] = HOURLY_FEATURES, carry: Sequence[str] = ("station",),
    kinds: Sequence[str] = KINDS,
) -> DataFrame:
    """(carry, model_key, predicted): each row scored by every model of its station, by joins."""
    linear = models.filter(F.col("weights").isNotNull()).select("station", "model_key", "weights")
    inputs = list(dict.fromkeys(["station", *carry, *features]))
    parts = [predict_linear(rows.select(*inputs), linear, features).select(*carry, "model_key", "predicted")]
    for kind in [k for k in kinds if k not in ("linear", "ridge")]:
        mine = models.filter((F.col("model_key") == kind) & F.col("trees").isNotNull())
        nodes = mine.select("station", F.explode("trees").alias("t")).select("station", "t.*")
        scored = score_trees(rows, nodes, features, list(carry))
        parts.append(scored.select(*carry, F.lit(kind).alias("model_key"), "predicted"))
    return reduce(DataFrame.unionByName, parts)


def training_run(
    split: DataFrame, active: DataFrame | None, version: int, features: Sequence[str] = HOURLY_FEATURES,
    target: str = HOURLY_TARGET, kinds: Sequence[str] = KINDS, min_rows: Mapping[str, int] = MIN_ROWS,
    metric: str = "rmse", margin: float = 0.0, **options,
) -> tuple[DataFrame, DataFrame]:
    """One run for all stations: (promoted, entries).

    The candidates and the models in production, taken from the registry, are scored on the same test
    rows. `active` has the registry's newest entry per station, or is None before the first
    run; a production model of another number of features cannot be scored and counts as absent.
    `entries` are the registry rows of the deployed models: (station, model_key, n_features, train_start,
    train_end, weights, trees, rmse, mae, version).
    """
    rows = stage_table(keep_sized(split, size_gate(split, min_rows)), "sized-rows")
    train, test = (rows.filter(F.col("split") == name) for name in ("train", "test"))
    models = train_models(train, features, target, kinds, **options)
    judged = lambda found: score_candidates(
        score_models(test, found, features, ["station", target], kinds).select(
            "station", F.col(target).alias("actual"), F.col("model_key").alias("model"), "predicted"
        )
    )
    best = champion(judged(models), metric)
    if active is None:
        production = best.limit(0)
    else:
        production = judged(active.filter(F.col("n_features") == len(features)))
    promoted = stage_table(promote(best, production, margin), "promoted")
    deployed = promoted.filter(F.col("status") == "DEPLOYED").select("station", F.col("model").alias("model_key"), "rmse", "mae")
    entries = models.join(deployed, ["station", "model_key"]).withColumn("version", F.lit(version))
    return promoted, entries
