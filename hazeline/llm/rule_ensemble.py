"""Quality classifier: a sparse ensemble of rules.

Text statistics are column expressions. A small random forest is grown on the labelled rows;
every path from a root to a node is a conjunctive rule over the statistics. Lasso logistic
regression weighs the rules and leaves most at zero. The rest is compiled into one column
expression, so scoring is a projection without Python.

Labels are learnt from the rows that `held_out` does not name; label, language, source and id are
never statistics. Null text is empty and gets a score. Labels that repeat for an id are averaged,
null labels and ids are left out. Without a labelled row the score is 0.5; with one class only it
is that class's smoothed share. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import held_out, whole
from hazeline.llm.quality_rules import plain_words
from hazeline.session import stage_table

STATISTICS = (
    "log_words", "mean_word", "distinct_share", "upper_share", "symbol_share", "bang_share", "bar_share",
    "digit_share", "stop_share", "line_share",
)
TREES = 16
DEPTH = 4
PENALTY = 0.002
ROUNDS = 40
SEED = 11
HELD_OUT = (3, 1)


def marks(text: Column, signs: str) -> Column:
    """Number of characters of a class; texts without any are not rewritten."""
    return F.when(text.rlike(signs), F.length(text) - F.length(F.regexp_replace(text, signs, ""))).otherwise(0)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, the statistics) for every row; texts are read once."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    parts = rows.select("doc_id", "text", plain_words(F.col("text")).alias("w"))
    text_ = F.col("text")
    counted = parts.select(
        "doc_id",
        F.size("w").alias("n"),
        F.size(F.array_distinct("w")).alias("distinct"),
        F.length(F.array_join("w", "")).alias("chars"),
        marks(text_, r"\p{Lu}").alias("upper"),
        marks(text_, r"[#*$%&<>]").alias("symbols"),
        marks(text_, "!").alias("bangs"),
        marks(text_, r"\|").alias("bars"),
        marks(text_, "[0-9]").alias("digits"),
        marks(text_, "[.]").alias("stops"),
        marks(text_, "\n").alias("lines"),
    )
    per = lambda part, of: F.col(part) / F.greatest(F.col(of), F.lit(1))
    return counted.select(
        "doc_id",
        F.log1p("n").alias("log_words"), per("chars", "n").alias("mean_word"),
        per("distinct", "n").alias("distinct_share"), per("upper", "chars").alias("upper_share"),
        per("symbols", "chars").alias("symbol_share"), per("bangs", "n").alias("bang_share"),
        per("bars", "n").alias("bar_share"), per("digits", "chars").alias("digit_share"),
        per("stops", "n").alias("stop_share"), per("lines", "n").alias("line_share"),
    )


Rule = tuple[tuple[int, float, float], ...]


def paths(tree) -> set[Rule]:
    """Every root-to-node path as bounds (statistic, above, up to), merged per statistic."""
    found: set[Rule] = set()

    def walk(node, bounds: dict[int, tuple[float, float]]) -> None:
        if bounds:
            found.add(tuple((f, low, high) for f, (low, high) in sorted(bounds.items())))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        feature, threshold = node.split().featureIndex(), node.split().threshold()
        low, high = bounds.get(feature, (float("-inf"), float("inf")))
        walk(node.leftChild(), {**bounds, feature: (low, min(high, threshold))})
        walk(node.rightChild(), {**bounds, feature: (max(low, threshold), high)})

    walk(tree._call_java("rootNode"), {})
    return found


def rule_column(rule: Rule, names: Sequence[str] = STATISTICS) -> Column:
    """1.0 where every bound of the rule holds."""
    bounds = []
    for feature, low, high in rule:
        if low > float("-inf"):
            bounds.append(F.col(names[feature]) > low)
        if high < float("inf"):
            bounds.append(F.col(names[feature]) <= high)
    return reduce(lambda a, b: a & b, bounds).cast("double")


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> tuple[float, list]:
    """(intercept, [(rule, weight)]) from rows with the statistics and a 0/1 `label`."""
    shares = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if shares[0] == 0 or shares[1] in (0.0, float(shares[0])):
        share = (shares[1] + 0.5) / (shares[0] + 1)
        return math.log(share / (1 - share)), []
    vectors = train.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, minInfoGain=1e-4, subsamplingRate=0.7)
    grown = forest.fit(vectors).trees
    rules = sorted(set().union(*[paths(tree) for tree in grown]))
    if not rules:
        share = shares[1] / shares[0]
        return math.log(share / (1 - share)), []
    matrix = train.select("label", array_to_vector(F.array(*[rule_column(r) for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=ROUNDS)
    model = lasso.fit(stage_table(matrix, "rule-matrix"))
    weights = model.coefficients.toArray().tolist()
    return float(model.intercept), [(r, w) for r, w in zip(rules, weights) if w != 0.0]


def score_column(intercept: float, weighted: list) -> Column:
    """The ensemble as one expression: the logistic of the weighted rules."""
    total = reduce(lambda a, rw: a + rule_column(rw[0]) * rw[1], weighted, F.lit(intercept))
    return 1 / (1 + F.exp(-total))


def classified(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    split: tuple[int, int] = HELD_OUT,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    rows = stage_table(statistics(docs, key, text), "text-statistics")
    out = held_out(F.col("doc_id"), *split)
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id"))
    known = known.agg((F.avg(label) >= 0.5).cast("double").alias("label"))
    train = stage_table(rows.join(known, "doc_id").filter(~out).select("label", *STATISTICS), "labelled-statistics")
    score = score_column(*fit(train))
    return rows.select("doc_id", out.alias("held_out"), score.alias("score")).select(
        "*", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
