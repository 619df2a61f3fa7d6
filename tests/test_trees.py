"""Histogram trees against a plain version that sees all rows of a station at once."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.operators import trees
from hazeline.operators.trees import TreeSpec

FEATURES = ["a", "b", "c"]
FOLDS = 2


def data(seed=3, n=90):
    dice, rows = np.random.default_rng(seed), []
    for station, count in (("x", n), ("y", n // 2)):
        for i in range(count):
            a, b = float(dice.normal()), float(dice.integers(0, 4))
            c = None if i % 11 == 0 else float(dice.normal())
            y = (3.0 if a > 0.2 else -1.0) * (b + 1) + float(dice.normal()) / 5
            rows.append((station, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), a, b, c, y, 3 * i // count))
    return rows


SCHEMA = "station string, ts timestamp_ntz, a double, b double, c double, y double, block int"


def plain_tree(x, g, w, spec, depth, node=1, level=0):
    """{node: (feature, bin)} and {node: value} of one tree by exhaustive cuts."""
    total, count = (w * g).sum(), w.sum()
    values, cuts = {node: total / (count + spec.l2)}, {}
    if level == depth or not count:
        return cuts, values
    best = (-np.inf, None, None)
    for feature in range(x.shape[1]):
        for cut in range(trees.BINS):
            left = x[:, feature] <= cut
            n = w[left].sum()
            if min(n, count - n) < spec.min_rows:
                continue
            gl = (w * g)[left].sum()
            gain = np.float32(gl**2 / (n + spec.l2) + (total - gl) ** 2 / (count - n + spec.l2))
            if gain > best[0]:
                best = (gain, feature, cut)
    if best[1] is None or best[0] <= np.float32(total**2 / (count + spec.l2)):
        return cuts, values
    cuts[node] = best[1:]
    left = x[:, best[1]] <= best[2]
    for side, at in ((0, left), (1, ~left)):
        c, v = plain_tree(x[at], g[at], w[at], spec, depth, 2 * node + side, level + 1)
        cuts.update(c)
        values.update(v)
    return cuts, values


def follow(x, cuts, values, depth):
    out = np.empty(len(x))
    for i, row in enumerate(x):
        node = 1
        while node in cuts and node < 1 << depth:
            feature, cut = cuts[node]
            node = 2 * node + int(row[feature] > cut)
        out[i] = values[node]
    return out


def plain_predictions(x, y, block, fold, spec, depth, weights):
    learns = block < fold if fold else np.ones(len(y), dtype=bool)
    state = np.full(len(y), y[learns].mean() if spec.boosted else 0.0)
    for t in range(spec.rounds):
        w = weights(t)[learns]
        g = (y - state if spec.boosted else y)[learns]
        cuts, values = plain_tree(x[learns], g, w, spec, max(spec.depths) if not spec.boosted else depth)
        share = spec.rate if spec.boosted else 1 / spec.rounds
        state = state + share * follow(x, cuts, values, depth)
    return state


def inputs(spark, rows, spec):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    edges = {r["station"]: r["edges"] for r in trees.quantile_edges(df, FEATURES).collect()}
    hashes = {
        (r["station"], r["ts"]): r["h"]
        for r in df.select("station", "ts", F.xxhash64("station", F.col("ts").cast("string")).alias("h")).collect()
    }
    by_station = {}
    for station in edges:
        own = sorted(r for r in rows if r[0] == station)
        raw = np.array([[np.nan if v is None else v for v in r[2:5]] for r in own])
        x = np.stack([np.searchsorted(np.array(edges[station][f]), raw[:, f], side="left") for f in range(3)], axis=1)
        holder = object.__new__(trees.Rows)
        holder.row = np.array([hashes[r[0], r[1]] for r in own])
        weights = holder.weights if spec.sampled else lambda t, n=len(own): np.ones(n)
        by_station[station] = (x, np.array([r[5] for r in own]), np.array([r[6] for r in own]), weights)
    return df, by_station


SPECS = [
    TreeSpec((1, 3), rounds=12, rate=0.3),
    TreeSpec((2, 4), rounds=7, boosted=False, l2=0.0, min_rows=4.0, sampled=True, together=3),
    TreeSpec((2,), rounds=1, boosted=False, l2=0.0, min_rows=1.0),
]


@pytest.mark.parametrize("spec", SPECS)
@pytest.mark.parametrize("chunk", [1 << 16, 60, 16])
def test_trees_equal_the_plain_version(spark, spec, chunk, monkeypatch):
    monkeypatch.setattr(trees, "CHUNK", chunk)
    monkeypatch.setattr(trees, "STATE_EVERY", 5)
    df, by_station = inputs(spark, data(), spec)
    found, errors = trees.fit_trees(df, FEATURES, "y", spec, FOLDS)
    got = {(r["station"], r["setting"], r["fold"]): (r["mae"], r["rows"]) for r in errors.collect()}
    assert len(got) == 2 * len(spec.depths) * FOLDS
    for (station, setting, fold), (mae, n) in got.items():
        x, y, block, weights = by_station[station]
        want = plain_predictions(x, y, block, fold, spec, spec.depths[setting], weights)
        tested = block == fold
        assert n == tested.sum() and mae == pytest.approx(np.abs(want - y)[tested].mean(), abs=1e-9)
    for setting, depth in enumerate(spec.depths):
        mine = found.filter(F.coalesce(F.col("setting") == setting, F.lit(True)) & (F.col("fold") == 0))
        scored = trees.score_trees(df, mine.withColumn("depth", F.lit(depth)), FEATURES, ["station", "ts", "y"])
        rows = sorted(tuple(r) for r in scored.collect())
        for station, (x, y, block, weights) in by_station.items():
            want = plain_predictions(x, y, block, 0, spec, depth, weights)
            assert [r[3] for r in rows if r[0] == station] == pytest.approx(list(want), abs=1e-9)


def test_sample_weights_are_poisson(spark):
    holder = object.__new__(trees.Rows)
    holder.row = spark.range(40_000).select(F.xxhash64("id")).toPandas().to_numpy()[:, 0]
    first, second = holder.weights(0), holder.weights(1)
    assert abs(first.mean() - 1) < 0.03 and abs(first.var() - 1) < 0.05
    assert abs((first == 0).mean() - np.exp(-1)) < 0.01 and abs(np.corrcoef(first, second)[0, 1]) < 0.02


def test_a_constant_target_has_no_cuts(spark):
    rows = [(*r[:5], 2.5, r[6]) for r in data(n=20)]
    spec = TreeSpec((3,), rounds=2)
    found, errors = trees.fit_trees(spark.createDataFrame(rows, SCHEMA), FEATURES, "y", spec, FOLDS)
    assert {r["feature"] for r in found.collect()} == {-1}
    assert all(r["mae"] == pytest.approx(0) for r in errors.collect())
