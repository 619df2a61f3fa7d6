"""Splits, training, selection and forecast queries over the test tables."""


from dataclasses import replace

from pyspark.sql import functions as F

from hazeline import tables
from hazeline.catalog import sql
from hazeline.catalog.registry import query
from hazeline.catalog.series import DAY, daily_windows, hourly
from hazeline.operators import features, fit, model, ranges, trees
from hazeline.operators.aggregate import daily_local_mean, regression_metrics
from hazeline.operators.training import train_linear_models, training_run
from hazeline.session import stage_table, work_dir
from hazeline.sources import versions
from hazeline.sources.tables import append_log

VAL_START, TEST_START = "2024-01-18", "2024-01-24"


def time(text):
    return F.lit(text).cast("timestamp_ntz")


def hourly_features(spark, sf_dir):
    return features.build_hourly_features(hourly(spark, sf_dir))


def split_features(spark, sf_dir, **options):
    return model.assign_split(hourly_features(spark, sf_dir), time(VAL_START), time(TEST_START), **options)


@query(
    "l1_relative_splits",
    """WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders)
    SELECT CAST(CAST(d - INTERVAL 42 MONTH AS DATE) AS VARCHAR) AS data_start, CAST(CAST(d - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS val_start,
    CAST(CAST(d - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS test_start, CAST(d AS VARCHAR) AS test_end FROM m""",
)
def relative_splits(spark, sf_dir):
    last = tables.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("last"))
    return last.select(*[c.alias(n) for n, c in model.relative_splits(F.col("last")).items()])


SPLIT = f"""split AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '{VAL_START}' THEN 'train' WHEN ts < TIMESTAMP '{TEST_START}' THEN 'val' ELSE 'test' END AS split
  FROM features)"""


@query(
    "l2_assign_split",
    f"WITH {sql.HOURLY_WIDE}, {SPLIT} SELECT station, CAST(ts AS VARCHAR) AS ts, split FROM split",
)
def assign_split(spark, sf_dir):
    return split_features(spark, sf_dir).select("station", "ts", "split")


@query(
    "l2_purged_split",
    f"""WITH {sql.HOURLY_WIDE}, {SPLIT} SELECT station, split, count(*) AS "rows" FROM split
    WHERE NOT (ts < TIMESTAMP '{VAL_START}' AND ts >= TIMESTAMP '{VAL_START}' - INTERVAL 24 HOUR)
    AND NOT (ts < TIMESTAMP '{TEST_START}' AND ts >= TIMESTAMP '{TEST_START}' - INTERVAL 24 HOUR) GROUP BY ALL""",
)
def purged_split(spark, sf_dir):
    purged = split_features(spark, sf_dir, purge_hours=24)
    return purged.groupBy("station", "split").agg(F.count("*").alias("rows"))


@query(
    "l2_fixed_split",
    f"""WITH {sql.DAILY} SELECT station, {DAY}, CASE WHEN date < DATE '1999-11-01' THEN 'train'
    WHEN date < DATE '2000-01-01' THEN 'val' ELSE 'test' END AS split FROM daily WHERE date >= DATE '1996-07-01'""",
)
def fixed_split(spark, sf_dir):
    val, test, first = (F.lit(t).cast("date") for t in ("1999-11-01", "2000-01-01", "1996-07-01"))
    daily = tables.daily_readings(spark, sf_dir)
    return model.assign_split(daily, val, test, first, "date").select("station", "date", "split")


FOLDS = """numbered AS (
  SELECT station, date, row_number() OVER (PARTITION BY station ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY station) AS n FROM daily),
blocks AS (
  SELECT station, date, CASE WHEN i < n - 3 * (n // 4) THEN 0 ELSE 1 + (i - (n - 3 * (n // 4))) // (n // 4) END AS block FROM numbered)"""


@query(
    "l3_time_folds",
    f"""WITH {sql.DAILY}, {FOLDS} SELECT station, CAST(fold AS INTEGER) AS fold, CASE WHEN fold = block THEN 'test' ELSE 'train' END AS role,
    count(*) AS "rows", CAST(min(date) AS VARCHAR) AS "first", CAST(max(date) AS VARCHAR) AS "last"
    FROM blocks JOIN (VALUES (1), (2), (3)) f(fold) ON block <= fold GROUP BY ALL""",
)
def time_folds(spark, sf_dir):
    blocked = model.time_folds(tables.daily_readings(spark, sf_dir), 3, "date", every="YEAR")
    return model.fold_sizes(blocked, 3, "date")


# training: the daily features of the order series

CUT = "2000-01-01"
FEATURES = list(features.DAILY_FEATURES)


def daily_features(spark, sf_dir):
    """The features of all stations, written once for the passes of the training jobs."""
    wide = features.build_daily_features(tables.daily_readings(spark, sf_dir))
    return stage_table(wide, "daily-features")


def train_and_test(df):
    late = F.col("date") >= F.lit(CUT).cast("date")
    return df.filter(~late), df.filter(late)


def test_metrics(scored, name):
    return regression_metrics(scored.withColumnRenamed("pm25", "actual")).withColumn("model", F.lit(name))


ONE_LAG = f"""{sql.DAILY},
lagged AS (SELECT station, date, pm25 AS y, lag(pm25, 1) OVER (PARTITION BY station ORDER BY date) AS x FROM daily QUALIFY x IS NOT NULL)"""
WIDE_ALPHAS = (1e3, 1e5, 1e6, 1e7)  # one lag has large sums, so only large alphas matter


def one_lag(spark, sf_dir):
    lagged = daily_windows(spark, sf_dir, lambda w: features.lag_columns(w, [1]), 1).dropna()
    return stage_table(lagged, "one-lag")


@query("l4_fit_linear")
def fit_linear(spark, sf_dir):
    train, test = train_and_test(daily_features(spark, sf_dir))
    weights = fit.fit_linear(train, FEATURES, "pm25")
    return test_metrics(fit.predict_linear(test, weights, FEATURES), "linear")


@query(
    "l4_fit_linear_one_lag",
    f"""WITH {ONE_LAG} SELECT station, round(regr_intercept(y, x), 6) AS intercept, round(regr_slope(y, x), 6) AS slope
    FROM lagged GROUP BY station""",
)
def fit_linear_one_lag(spark, sf_dir):
    weights = fit.fit_linear(one_lag(spark, sf_dir), ["pm25_lag_1"], "pm25")
    return weights.select("station", F.col("weights")[0].alias("intercept"), F.col("weights")[1].alias("slope"))


@query(
    "l5_fit_ridge_one_lag",
    f"""WITH {ONE_LAG}, sums AS (
      SELECT station, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + 1e6) AS slope
      FROM lagged GROUP BY station)
    SELECT station, round(my - slope * mx, 6) AS intercept, round(slope, 6) AS slope FROM sums""",
)
def fit_ridge_one_lag(spark, sf_dir):
    rows = one_lag(spark, sf_dir).withColumn("block", F.lit(0))
    weights = fit.fit_ridge(fit.product_sums(rows, ["pm25_lag_1"], "pm25"), 1, [1e6])
    return weights.select("station", F.col("weights")[0].alias("intercept"), F.col("weights")[1].alias("slope"))


@query(
    "l8_grid_search_one_lag",
    f"""WITH {ONE_LAG}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY station ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY station) AS n FROM lagged),
    blocks AS (
      SELECT station, x, y, CASE WHEN i < n - 3 * (n // 4) THEN 0 ELSE 1 + (i - (n - 3 * (n // 4))) // (n // 4) END AS block FROM numbered),
    sums AS (
      SELECT station, fold, avg(x) AS mx, avg(y) AS my, covar_pop(y, x) * count(*) AS sxy, var_pop(x) * count(*) AS sxx
      FROM blocks JOIN (VALUES (1), (2), (3)) f(fold) ON block < fold GROUP BY station, fold),
    fits AS (
      SELECT station, fold, CAST(alpha AS DOUBLE) AS alpha, sxy / (sxx + alpha) AS slope, my - sxy / (sxx + alpha) * mx AS intercept
      FROM sums JOIN (VALUES {", ".join(f"({a})" for a in WIDE_ALPHAS)}) a(alpha) ON true),
    errors AS (
      SELECT b.station, alpha, fold, avg(abs(y - intercept - slope * x)) AS mae
      FROM blocks b JOIN fits f ON f.station = b.station AND fold = block GROUP BY ALL),
    means AS (SELECT station, alpha, avg(mae) AS mean_mae FROM errors GROUP BY ALL)
    SELECT station, alpha, round(mean_mae, 6) AS mean_mae,
    CAST(row_number() OVER (PARTITION BY station ORDER BY mean_mae, alpha) AS INTEGER) AS rank FROM means""",
)
def grid_search_one_lag(spark, sf_dir):
    blocked = stage_table(model.time_folds(one_lag(spark, sf_dir), 3, "date", every="YEAR"), "folds")
    return fit.ridge_grid_search(blocked, ["pm25_lag_1"], "pm25", WIDE_ALPHAS).drop("weights")


@query("l5_fit_ridge")
def fit_ridge(spark, sf_dir):
    train, test = train_and_test(daily_features(spark, sf_dir))
    sums = fit.product_sums(train.withColumn("block", F.lit(0)), FEATURES, "pm25")
    weights = fit.fit_ridge(sums, len(FEATURES), [10.0]).select("station", "weights")
    return test_metrics(fit.predict_linear(test, weights, FEATURES), "ridge")


BALANCED = f"""SELECT station, feature, true AS balanced FROM (SELECT DISTINCT o_orderpriority AS station FROM orders),
    (VALUES ('intercept'), {", ".join(f"('{f}')" for f in FEATURES)}) v(feature)"""


def normal_equations(spark, sf_dir, alpha):
    """(station, feature, balanced): whether the fit on all features meets its normal equation, the sum
    of feature times residual being alpha times the weight, to 1e-8 of the sum of its absolute terms."""
    train, _ = train_and_test(daily_features(spark, sf_dir))
    sums = fit.product_sums(train.withColumn("block", F.lit(0)), FEATURES, "pm25")
    weights = stage_table(fit.fit_ridge(sums, len(FEATURES), [alpha]).select("station", "weights"), "weights")
    rest = F.col("pm25") - F.col("predicted")
    rows = fit.predict_linear(train, weights, FEATURES).withColumn("rest", rest).withColumn("one", F.lit(1.0))
    names = {"intercept": "one", **{f: f for f in FEATURES}}
    checks = [
        F.struct(
            F.lit(name).alias("feature"), F.lit(i).alias("at"), F.sum(F.col(c) * F.col("rest")).alias("gap"),
            F.sum(F.abs(F.col(c) * F.col("pm25"))).alias("scale"),
        )
        for i, (name, c) in enumerate(names.items())
    ]
    found = rows.groupBy("station").agg(F.array(*checks).alias("c")).select("station", F.explode("c").alias("c")).select("station", "c.*")
    penalty = F.when(F.col("at") > 0, alpha * F.get("weights", F.col("at"))).otherwise(0.0)
    return found.join(weights, "station").select(
        "station", "feature", (F.abs(F.col("gap") - penalty) <= 1e-8 * (F.col("scale") + 1)).alias("balanced")
    )


@query("l4_normal_equations", BALANCED)
def linear_normal_equations(spark, sf_dir):
    return normal_equations(spark, sf_dir, 0.0)


@query("l5_normal_equations", BALANCED)
def ridge_normal_equations(spark, sf_dir):
    return normal_equations(spark, sf_dir, 10.0)


def tree_metrics(spark, sf_dir, spec, name):
    train, test = train_and_test(daily_features(spark, sf_dir))
    found, _ = trees.fit_trees(train.withColumn("block", F.lit(0)), FEATURES, "pm25", spec, 0, "date")
    mine = found.withColumn("depth", F.lit(spec.depths[0]))
    return test_metrics(trees.score_trees(test, mine, FEATURES, ["station", "pm25"]), name)


@query("l6_fit_forest")
def fit_forest(spark, sf_dir):
    return tree_metrics(spark, sf_dir, replace(trees.FOREST, depths=(5,)), "forest")


@query("l7_fit_gbt")
def fit_gbt(spark, sf_dir):
    return tree_metrics(spark, sf_dir, replace(trees.BOOSTED, depths=(3,)), "boosted")


HOURLY = list(features.HOURLY_FEATURES)


def tree_search(spark, sf_dir, spec, name):
    """Full grid of a tree learner over three time folds of each station's training hours.

    One row per station and setting; the first rank also has the errors of its refit on the test hours.
    """
    rows = stage_table(split_features(spark, sf_dir), "split-features")
    blocked = stage_table(model.time_folds(rows.filter(F.col("split") == "train"), 3), "folds")
    target = features.HOURLY_TARGET
    found, best = trees.tree_search(blocked, HOURLY, target, spec)
    tested = trees.score_trees(rows.filter(F.col("split") == "test"), best, HOURLY, ["station", target])
    errors = regression_metrics(tested.withColumnRenamed(target, "actual")).withColumn("rank", F.lit(1))
    return found.withColumn("model", F.lit(name)).join(errors, ["station", "rank"], "left")


@query("l6_forest_grid_search")
def forest_grid_search(spark, sf_dir):
    return tree_search(spark, sf_dir, trees.FOREST, "forest")


@query("l7_gbt_grid_search")
def gbt_grid_search(spark, sf_dir):
    return tree_search(spark, sf_dir, trees.BOOSTED, "boosted")


def tree_sql(depth, boosted, l2, min_rows):
    """CTEs that grow one tree by exhaustive cuts between even bins, ending in `cuts`."""
    listed = ", ".join(f"({i}, {name}::DOUBLE)" for i, name in enumerate(HOURLY))
    score = lambda g, n: f"({g}) * ({g}) / (({n}) + {l2}::DOUBLE)"
    parts = [f"""learn AS (SELECT *, row_number() OVER () AS rid FROM split WHERE split = 'train'),
    based AS (SELECT station, {"avg(pm25_h24)" if boosted else "0.0::DOUBLE"} AS base FROM learn GROUP BY station),
    long AS (SELECT l.station, rid, pm25_h24 - base AS g, v.f, v.x FROM learn l JOIN based USING (station), LATERAL (VALUES {listed}) v(f, x)),
    spans AS (SELECT station, f, min(x) AS a, max(x) AS b FROM long GROUP BY ALL),
    edges AS (SELECT station, f, list_transform(range(1, {trees.BINS}), lambda k: a + (b - a) * (k / {trees.BINS}.0::DOUBLE)) AS e FROM spans),
    binned AS (SELECT station, rid, g, f, CASE WHEN x IS NULL THEN {trees.BINS - 1} ELSE len(list_filter(e, lambda v: v < x)) END AS bin
      FROM long JOIN edges USING (station, f)),
    nodes0 AS (SELECT rid, 1 AS node FROM learn)"""]
    for level in range(depth):
        parts.append(f"""cells{level} AS (SELECT station, node, f, bin, sum(g) AS g, count(*) AS n FROM binned JOIN nodes{level} USING (rid) GROUP BY ALL),
    running{level} AS (SELECT station, node, f, bin, sum(g) OVER r AS left_g, sum(n) OVER r AS left_n, sum(g) OVER t AS g, sum(n) OVER t AS n
      FROM cells{level} WINDOW t AS (PARTITION BY station, node, f), r AS (PARTITION BY station, node, f ORDER BY bin)),
    best{level} AS (SELECT *, ({score("left_g", "left_n")} + {score("g - left_g", "n - left_n")})::FLOAT AS gain FROM running{level}
      WHERE left_n >= {min_rows} AND n - left_n >= {min_rows}
      QUALIFY row_number() OVER (PARTITION BY station, node ORDER BY gain DESC, f, bin) = 1),
    cuts{level} AS (SELECT * FROM best{level} WHERE gain > ({score("g", "n")})::FLOAT),
    nodes{level + 1} AS (SELECT b.rid, 2 * c.node + CASE WHEN b.bin > c.bin THEN 1 ELSE 0 END AS node FROM nodes{level} d
      JOIN binned b USING (rid) JOIN cuts{level} c ON c.station = b.station AND c.node = d.node AND c.f = b.f)""")
    union = " UNION ALL ".join(f"SELECT * FROM cuts{level}" for level in range(depth))
    parts.append(f"""cuts AS (SELECT c.station, c.node, c.f AS feature, round(e[c.bin + 1], 6) AS threshold,
      round(left_g / (left_n + {l2}::DOUBLE), 6) AS left_value, round((g - left_g) / (n - left_n + {l2}::DOUBLE), 6) AS right_value,
      round(base, 6) AS base FROM ({union}) c JOIN edges e ON e.station = c.station AND e.f = c.f JOIN based b ON b.station = c.station)""")
    return ",\n    ".join(parts)


def single_tree(spark, sf_dir, spec):
    """The nodes of one tree between even bins; its twin tries every cut in SQL."""
    train = stage_table(split_features(spark, sf_dir).filter(F.col("split") == "train"), "train").withColumn("block", F.lit(0))
    edges = trees.even_edges(train, HOURLY)
    found, _ = trees.fit_trees(train, HOURLY, features.HOURLY_TARGET, spec, 0, edges=edges)
    return found.filter(F.col("feature") >= 0).select("station", "node", "feature", "threshold", "left_value", "right_value", "base")


ONE_TREE = trees.TreeSpec((3,), rounds=1, boosted=False, l2=0.0, min_rows=4.0)
ONE_ROUND = trees.TreeSpec((1,), rounds=1)


@query("l6_one_tree", f"WITH {sql.HOURLY_WIDE}, {SPLIT}, {tree_sql(3, False, 0.0, 4)} SELECT * FROM cuts")
def one_tree(spark, sf_dir):
    return single_tree(spark, sf_dir, ONE_TREE)


@query("l7_first_round", f"WITH {sql.HOURLY_WIDE}, {SPLIT}, {tree_sql(1, True, 1.0, 1)} SELECT * FROM cuts")
def first_round(spark, sf_dir):
    return single_tree(spark, sf_dir, ONE_ROUND)


@query("l8_ridge_grid_search")
def ridge_grid_search(spark, sf_dir):
    train, _ = train_and_test(daily_features(spark, sf_dir))
    blocked = stage_table(model.time_folds(train, 3, "date", every="YEAR"), "folds")
    return fit.ridge_grid_search(blocked, FEATURES, "pm25", fit.RIDGE_ALPHAS).drop("weights")


# selection with fixed forecasters

FORECASTERS = {
    "last_hour": {"pm25_lag_1": 1.0},
    "same_hour": {"pm25_lag_24": 1.0},
    "blend": {"pm25_lag_1": 0.25, "pm25_lag_24": 0.25, "pm25_rolling_mean_24h": 0.5},
}
FORECASTER_SQL = {
    "last_hour": "pm25_lag_1",
    "same_hour": "pm25_lag_24",
    "blend": "pm25_lag_1 * 0.25 + pm25_lag_24 * 0.25 + pm25_rolling_mean_24h * 0.5",
}


def scored_test(spark, sf_dir):
    models = {name: model.linear_score(weights) for name, weights in FORECASTERS.items()}
    test = split_features(spark, sf_dir).filter(F.col("split") == "test")
    return model.score_batch(test, models, features.HOURLY_TARGET, "ts")


SCORED = f"""{sql.HOURLY_WIDE}, {SPLIT},
scored AS ({" UNION ALL ".join(
    f"SELECT station, ts, pm25_h24 AS actual, '{n}' AS model, {e} AS predicted FROM split WHERE split = 'test'"
    for n, e in FORECASTER_SQL.items())})"""
CANDIDATES = f"{SCORED}, {sql.metrics('scored', 'station, model')}"
CHAMPION = f"""{CANDIDATES},
champion AS (SELECT * FROM metrics QUALIFY row_number() OVER (PARTITION BY station ORDER BY rmse, model) = 1)"""


@query("l9_score_candidates", f"WITH {CANDIDATES} SELECT * FROM metrics")
def score_candidates(spark, sf_dir):
    return model.score_candidates(scored_test(spark, sf_dir))


@query("l10_champion", f"WITH {CHAMPION} SELECT * FROM champion")
def champion(spark, sf_dir):
    return model.champion(model.score_candidates(scored_test(spark, sf_dir)))


# production is the same_hour forecaster; one station has none yet
PROMOTED = f"""{CHAMPION},
production AS (SELECT station, rmse AS old_rmse, mae AS old_mae FROM metrics WHERE model = 'same_hour' AND station <> 'view'),
promoted AS (
  SELECT c.station, c.model, c.rmse, c.mae, old_rmse, round(old_rmse - c.rmse, 4) AS delta_rmse, round(old_mae - c.mae, 4) AS delta_mae,
    CASE WHEN old_rmse IS NULL OR c.rmse < old_rmse THEN 'DEPLOYED' ELSE 'NOT_DEPLOYED' END AS status
  FROM champion c LEFT JOIN production p ON p.station = c.station)"""


def staged_metrics(spark, sf_dir):
    return stage_table(model.score_candidates(scored_test(spark, sf_dir)), "metrics")


def promoted_models(spark, sf_dir):
    metrics = staged_metrics(spark, sf_dir)
    production = metrics.filter((F.col("model") == "same_hour") & (F.col("station") != "view"))
    return model.promote(model.champion(metrics), production)


@query("l11_promote", f"WITH {PROMOTED} SELECT * FROM promoted")
def promote(spark, sf_dir):
    return promoted_models(spark, sf_dir)


@query(
    "l12_active_models",
    f"""WITH {PROMOTED}, registry AS (
      SELECT station, 'same_hour' AS model_key, old_rmse AS rmse, old_mae AS mae, 1 AS version FROM production
      UNION ALL SELECT station, model, rmse, mae, 2 FROM promoted WHERE status = 'DEPLOYED')
    SELECT station, model_key, rmse, mae, CAST(version AS INTEGER) AS version FROM registry
    QUALIFY row_number() OVER (PARTITION BY station ORDER BY version DESC) = 1""",
)
def active_models(spark, sf_dir):
    metrics = staged_metrics(spark, sf_dir)
    production = metrics.filter((F.col("model") == "same_hour") & (F.col("station") != "view"))
    first = production.select("station", F.col("model").alias("model_key"), "rmse", "mae", F.lit(1).alias("version"))
    promoted = model.promote(model.champion(metrics), production)
    return model.active_models(model.registry_update(first, promoted, 2))


@query(
    "l13_score_batch",
    f"""WITH {SCORED} SELECT station, CAST(ts AS VARCHAR) AS ts, round(actual, 6) AS actual, model, round(predicted, 6) AS predicted
    FROM scored""",
)
def score_batch(spark, sf_dir):
    return scored_test(spark, sf_dir)


@query("l11_train_and_promote")
def train_and_promote(spark, sf_dir):
    """Linear and ridge trained on the hourly features against the same_hour forecaster."""
    split = stage_table(split_features(spark, sf_dir), "split-features")
    test = split.filter(F.col("split") == "test")
    production = regression_metrics(test, actual=features.HOURLY_TARGET, predicted="pm25_lag_24")
    return train_linear_models(split, production)[0]


# two runs of the training with one input: the second meets the first one's models on its own test rows
RUNS = f"""{sql.HOURLY_WIDE},
fits AS (
  SELECT station, 1 AS version, regr_intercept(pm25_h24, pm25_lag_1) AS intercept, regr_slope(pm25_h24, pm25_lag_1) AS slope,
    min(ts) AS first, max(ts) AS last FROM features WHERE ts < TIMESTAMP '2024-01-12' GROUP BY station
  UNION ALL SELECT station, 2, regr_intercept(pm25_h24, pm25_lag_1), regr_slope(pm25_h24, pm25_lag_1), min(ts), max(ts)
    FROM features WHERE ts < TIMESTAMP '2024-01-24' GROUP BY station),
tests AS (
  SELECT station, 1 AS run, ts, pm25_lag_1, pm25_h24 FROM features WHERE ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-18'
  UNION ALL SELECT station, 2, ts, pm25_lag_1, pm25_h24 FROM features WHERE ts >= TIMESTAMP '2024-01-24'),
tried AS (
  SELECT station, run, version, pm25_h24 AS actual, intercept + slope * pm25_lag_1 AS predicted
  FROM tests JOIN fits USING (station) WHERE version <= run),
{sql.metrics("tried", "station, run, version")},
promoted AS (
  SELECT c.station, 'linear' AS model, c.rmse, c.mae, p.rmse AS old_rmse, round(p.rmse - c.rmse, 4) AS delta_rmse,
    round(p.mae - c.mae, 4) AS delta_mae, CASE WHEN p.rmse IS NULL OR c.rmse < p.rmse THEN 'DEPLOYED' ELSE 'NOT_DEPLOYED' END AS status
  FROM metrics c LEFT JOIN metrics p ON p.station = c.station AND p.run = 2 AND p.version = 1
  WHERE c.run = 2 AND c.version = 2),
active AS (
  SELECT f.station, f.version, 'linear' AS model_key, 1 AS n_features, CAST(CAST(f.first AS DATE) AS VARCHAR) AS train_start,
    CAST(CAST(f.last AS DATE) AS VARCHAR) AS train_end, intercept, slope, m.rmse, m.mae
  FROM fits f JOIN metrics m ON m.station = f.station AND m.version = f.version AND m.run = f.version
  WHERE f.version = 1 OR f.station IN (SELECT station FROM promoted WHERE status = 'DEPLOYED')
  QUALIFY row_number() OVER (PARTITION BY f.station ORDER BY f.version DESC) = 1)"""
ONE_INPUT = ["pm25_lag_1"]


def registry_rounds(spark, sf_dir):
    """(promoted, active): results of the second run and the registry as it is stored after it."""
    rows = stage_table(hourly_features(spark, sf_dir), "features")
    path, active = work_dir(spark, "registry"), None
    for version, (cut, end) in enumerate((("2024-01-12", "2024-01-18"), ("2024-01-24", "2024-03-01")), start=1):
        split = model.assign_split(rows.filter(F.col("ts") < time(end)), time(cut), time(cut))
        promoted, entries = training_run(
            split, active, version, ONE_INPUT, kinds=["linear"], min_rows={"train": 1, "test": 1}
        )
        append_log(entries, path)
        active = model.active_models(spark.read.schema(entries.schema).parquet(path))
    return promoted, active


@query("l11_training_run", f"WITH {RUNS} SELECT * FROM promoted")
def two_training_runs(spark, sf_dir):
    return registry_rounds(spark, sf_dir)[0]


@query(
    "l12_registry_weights",
    f"""WITH {RUNS} SELECT station, CAST(version AS INTEGER) AS version, model_key, CAST(n_features AS INTEGER) AS n_features, train_start, train_end,
    round(intercept, 6) AS intercept, round(slope, 6) AS slope, rmse, mae FROM active""",
)
def registry_weights(spark, sf_dir):
    active = registry_rounds(spark, sf_dir)[1]
    weights = [F.col("weights")[i].alias(n) for i, n in enumerate(("intercept", "slope"))]
    return active.select("station", "version", "model_key", "n_features", "train_start", "train_end", *weights, "rmse", "mae")


@query(
    "o2_leaderboard",
    f"""WITH {CANDIDATES}, overall AS (SELECT model, round(avg(mae), 6) AS mae, round(avg(rmse), 6) AS rmse FROM metrics GROUP BY model)
    SELECT * FROM overall ORDER BY mae, model LIMIT 2""",
)
def leaderboard(spark, sf_dir):
    metrics = model.score_candidates(scored_test(spark, sf_dir))
    overall = metrics.groupBy("model").agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"))
    return ranges.leaderboard(overall, 2)


@query(
    "l19_training_report",
    f"""WITH {PROMOTED}, spans AS (
      SELECT station, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS train_start, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS train_end
      FROM split WHERE split = 'train' GROUP BY station)
    SELECT station, train_start, train_end, model AS best_model, rmse, mae, old_rmse, delta_rmse, status, '2024-01-31' AS run_date
    FROM promoted LEFT JOIN spans USING (station)""",
)
def training_report(spark, sf_dir):
    report = model.training_report(
        promoted_models(spark, sf_dir), split_features(spark, sf_dir), F.lit("2024-01-31")
    )
    path = work_dir(spark, "training-report")
    append_log(report, path)
    return spark.read.schema(report.schema).parquet(path)


# forecasts

NEXT_DAY_WEIGHTS = {"pm25_lag_1": 0.5, "pm25_lag_7": 0.3, "pm25_rolling_mean_14": 0.2}


@query(
    "l15_forecast_next_day",
    f"""WITH {sql.DAILY}, ranked AS (
      SELECT station, date, pm25 * 1.02 AS pm25, row_number() OVER (PARTITION BY station ORDER BY date) AS rn FROM daily),
    w AS (
      SELECT station, date, pm25, count(*) OVER h AS n, max(pm25) OVER h AS hi, lag(pm25, 6) OVER s AS l7,
        avg(pm25) OVER f14 AS m14
      FROM ranked WINDOW s AS (PARTITION BY station ORDER BY rn), h AS (PARTITION BY station ORDER BY rn ROWS BETWEEN 14 PRECEDING AND CURRENT ROW),
        f14 AS (PARTITION BY station ORDER BY rn ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
    SELECT station, CAST(date AS VARCHAR) AS day, CAST(date + 1 AS VARCHAR) AS prediction_date,
    round(0.5 * pm25 + 0.3 * l7 + 0.2 * m14, 6) AS predicted FROM w WHERE n = 15 AND hi <= 500""",
)
def forecast_next_day(spark, sf_dir):
    forecasts = model.forecast_next_day(
        tables.history_requests(spark, sf_dir), model.linear_score(NEXT_DAY_WEIGHTS), places=6
    )
    return forecasts.select(
        "request.station",
        F.col("request.date").alias("day"),
        "prediction_date",
        "predicted",
    )


JOBS = f"""{sql.HOURLY}, {sql.STATIONS},
means AS (
  SELECT station, CAST(ts + INTERVAL 7 HOUR AS DATE) AS date, CAST(round(CAST(avg(pm25) AS DECIMAL(38,12)), 2) AS DOUBLE) AS pm25
  FROM readings WHERE CAST(ts + INTERVAL 7 HOUR AS DATE) BETWEEN DATE '2023-12-25' AND DATE '2024-02-04' GROUP BY ALL),
days AS (
  SELECT station, CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-04', INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT DISTINCT station FROM means)),
filled AS (
  SELECT d.station, d.date, m.pm25 IS NULL AS missing, last_value(m.pm25 IGNORE NULLS) OVER (PARTITION BY d.station ORDER BY d.date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pm25
  FROM days d LEFT JOIN means m ON m.station = d.station AND m.date = d.date),
newest AS (SELECT station, max(date) AS latest FROM means GROUP BY station),
known AS (SELECT station, latest FROM stations LEFT JOIN newest USING (station)),
targets AS (
  SELECT station, latest, CAST(unnest(generate_series(DATE '2024-01-16', least(DATE '2024-02-05', latest + 1), INTERVAL 1 DAY)) AS DATE) AS target
  FROM known WHERE latest IS NOT NULL
  UNION ALL SELECT station, NULL, NULL FROM known WHERE latest IS NULL),
joined AS (
  SELECT t.station, t.target, t.latest, count(f.date) AS n, count(*) FILTER (f.date IS NOT NULL AND f.pm25 IS NULL) AS holes,
    count(*) FILTER (f.missing AND f.pm25 IS NOT NULL) AS filled, round(sum(f.pm25), 2) AS total,
    max(CAST(f.pm25 AS DECIMAL(18,2))) FILTER (f.date = t.target - 1) AS lag1,
    max(CAST(f.pm25 AS DECIMAL(18,2))) FILTER (f.date = t.target - 7) AS lag7,
    sum(CAST(f.pm25 AS DECIMAL(18,2))) FILTER (f.date >= t.target - 14) AS sum14
  FROM targets t LEFT JOIN filled f ON f.station = t.station AND f.date BETWEEN t.target - 15 AND t.target - 1 GROUP BY ALL),
jobs AS (
  SELECT station, CAST(target AS VARCHAR) AS target_date,
    CASE WHEN latest IS NULL THEN 'no_daily_data' WHEN n <> 15 THEN 'insufficient_history_window'
         WHEN holes > 0 THEN 'history_contains_missing_pm25' END AS skip_reason,
    target, filled, total, CAST(round(CAST((lag1 * 35 + lag7 * 21 + sum14) / 70 AS DECIMAL(38,12)), 2) AS DOUBLE) AS predicted
  FROM joined)"""


@query(
    "l16_prediction_jobs",
    f"""WITH {JOBS} SELECT station, target_date, skip_reason,
    CASE WHEN skip_reason IS NULL THEN CAST(target - 15 AS VARCHAR) END AS history_start_date,
    CASE WHEN skip_reason IS NULL THEN CAST(target - 1 AS VARCHAR) END AS history_end_date,
    CASE WHEN skip_reason IS NULL THEN filled END AS filled_history_days,
    CASE WHEN skip_reason IS NULL THEN round(total, 2) END AS history_total FROM jobs""",
)
def prediction_jobs(spark, sf_dir):
    total = F.aggregate("history", F.lit(0.0), lambda acc, h: acc + h["pm25"])
    jobs = manual_jobs(spark, sf_dir)
    return jobs.withColumn("history_total", F.round(total, 2)).drop("history")


def manual_jobs(spark, sf_dir):
    return jobs_of(spark, sf_dir, "2024-02-10", "2024-01-16", "2024-02-05")


def jobs_of(spark, sf_dir, *days):
    since, until = model.job_bounds(spark, *days)
    readings = tables.hourly_readings(spark, sf_dir, since=since, until=until)
    return model.prediction_jobs(readings, tables.event_stations(spark, sf_dir), *days)


@query(
    "l16_scheduled_jobs",
    """SELECT station, skip_reason, target_date FROM (
      SELECT event_type AS station, CAST(NULL AS VARCHAR) AS skip_reason,
             CAST(CAST(max(ts) + INTERVAL 7 HOUR AS DATE) + 1 AS VARCHAR) AS target_date FROM events GROUP BY event_type
      UNION ALL SELECT 'offline', 'no_daily_data', NULL)""",
)
def scheduled_jobs(spark, sf_dir):
    return jobs_of(spark, sf_dir, "2024-02-01").select("station", "skip_reason", "target_date")


STORED = f"""WITH {JOBS}, old AS (SELECT station, date AS prediction_date, pm25 AS predicted_pm25, 'old' AS model FROM means),
    fresh AS (SELECT station, target AS prediction_date, predicted AS predicted_pm25, 'blend' AS model, 15 AS history_days,
      target - 15 AS history_start_date, target - 1 AS history_end_date, filled AS filled_history_days, 'manual' AS run_type,
      TIMESTAMP '2024-02-10' AS prediction_generated_at FROM jobs WHERE skip_reason IS NULL),
    stored AS (SELECT * FROM fresh UNION ALL BY NAME SELECT * FROM old o WHERE NOT EXISTS (
      SELECT 1 FROM fresh f WHERE f.station = o.station AND f.prediction_date = o.prediction_date))
    SELECT station, CAST(prediction_date AS VARCHAR) AS prediction_date, model, predicted_pm25, CAST(history_days AS INTEGER) AS history_days,
    CAST(history_start_date AS VARCHAR) AS history_start_date, CAST(history_end_date AS VARCHAR) AS history_end_date,
    filled_history_days, run_type, CAST(prediction_generated_at AS VARCHAR) AS prediction_generated_at FROM stored"""


@query("l17_store_predictions", STORED)
def store_predictions(spark, sf_dir):
    return model.store_predictions(*old_and_fresh(spark, sf_dir))


@query("l17_store_predictions_table", STORED)
def store_predictions_table(spark, sf_dir):
    """The same through the sink by day, the fresh rows twice."""
    path = work_dir(spark, "predictions")
    old, fresh = (stage_table(df, "predictions") for df in old_and_fresh(spark, sf_dir))
    for rows in (old, fresh, fresh):
        versions.upsert_table(spark, path, rows.select(*old.columns), ["prediction_generated_at"])
    return versions.read_table(spark, path).drop("day")


def old_and_fresh(spark, sf_dir):
    jobs = manual_jobs(spark, sf_dir)
    score = model.linear_score(NEXT_DAY_WEIGHTS)
    fresh = model.job_predictions(jobs, score, "blend", "manual", time("2024-02-10"))
    since, until = model.job_bounds(spark, "2024-02-10", "2024-01-16", "2024-02-05")
    means = daily_local_mean(tables.hourly_readings(spark, sf_dir, since=since, until=until), "2023-12-25", "2024-02-04")
    empty = {
        name: F.lit(None).cast(kind)
        for name, kind in fresh.dtypes
        if name not in ("station", "prediction_date", "predicted_pm25", "model")
    }
    old = means.select(
        "station", F.col("date").alias("prediction_date"), F.col("pm25").alias("predicted_pm25"), F.lit("old").alias("model")
    ).withColumns(empty)
    return old, fresh


@query(
    "l18_forecast_latest",
    f"""WITH {sql.SERIES}, w AS (
      SELECT station, ts, lag(pm25, 1) OVER s AS l1, lag(pm25, 24) OVER s AS l24 FROM series WINDOW s AS (PARTITION BY station ORDER BY ts))
    SELECT station, CAST(ts AS VARCHAR) AS base_ts, CAST(ts + INTERVAL 24 HOUR AS VARCHAR) AS forecast_ts,
    round(l1 * 0.5 + l24 * 0.5, 6) AS predicted FROM w QUALIFY ts = max(ts) OVER (PARTITION BY station)""",
)
def forecast_latest(spark, sf_dir):
    score = model.linear_score({"pm25_lag_1": 0.5, "pm25_lag_24": 0.5})
    return model.forecast_latest(
        hourly(spark, sf_dir), lambda df: df.withColumn("predicted", score), places=6
    )
