"""Licence scan: ordered signature rules, in DataFrame operations only.

Texts become lower-case words joined by single blanks. A text without any gate keyword is done.
The others try the rules of whose two lists of keywords they hold one each; the places of a match follow from the words
in the pieces between matches. Detections are then sorted by start: one that lies inside an
earlier one of at least its own priority is suppressed, which running maxima of the ends decide in
one pass. Base phrases are always kept.

Null text has no words. Rows are told apart by a staged row id, so rows that repeat a doc_id each
get a result. Detections of one text are sorted together, and they are bounded by its length. An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import lower_ascii, whole
from hazeline.llm.license_rules import gates, rules_json
from hazeline.session import stage_table

# Everything but digits, letters and non-ASCII code points, before lower-casing.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RULE_TYPE = (
    "array<struct<rule int, regex string, label string, keys array<string>, "
    "keys2 array<string>, priority int, confidence double, base boolean>>"
)
PRIORITIES = (1, 2, 3, 4)


def blanks(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_id, doc_id, n_words, words): words only where a gate keyword occurs. Texts are read once."""
    flat = docs.select(
        F.col(key).alias("doc_id"), F.regexp_replace(whole(F.col(text)), BETWEEN_WORDS, " ").alias("raw")
    ).select("doc_id", F.btrim("raw").alias("flat"))
    low = F.lower("flat")
    gate = reduce(lambda a, b: a | b, [F.contains(low, F.lit(word)) for word in gates()])
    rows = flat.select(
        F.monotonically_increasing_id().alias("row_id"),
        "doc_id",
        F.when(F.col("flat") == "", 0).otherwise(blanks(F.col("flat")) + 1).cast("long").alias("n_words"),
        F.when(gate, F.concat(F.lit(" "), lower_ascii(F.col("flat")), F.lit(" "))).alias("words"),
    )
    return stage_table(rows, "license-words")


def detections(rows: DataFrame) -> DataFrame:
    """One row per match: (row_id, rule, label, priority, confidence, base, start, end, kept);
    start and end count words from 0, end is exclusive."""
    listed = F.from_json(F.lit(rules_json()), RULE_TYPE)
    words = F.col("words")
    held = lambda keys: F.exists(keys, lambda k: F.contains(words, k))
    open_rules = F.filter(listed, lambda r: held(r["keys2"]) & held(r["keys"]))
    tried = rows.filter(words.isNotNull()).select("row_id", "words", F.explode(open_rules).alias("r"))
    hits = tried.select(
        "row_id", "words", "r.*", F.regexp_extract_all("words", F.col("r.regex"), F.lit(0)).alias("matches")
    ).filter(F.size("matches") > 0)
    pieces = hits.select(
        "row_id", "rule", "label", "priority", "confidence", "base",
        F.posexplode(F.arrays_zip(F.split("words", F.col("regex"), -1).alias("piece"), F.col("matches").alias("match"))),
    ).filter(F.col("col.match").isNotNull())
    rule_order = Window.partitionBy("row_id", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    length = blanks(F.col("col.match")) + 1
    seen = F.sum(blanks(F.col("col.piece")) + length - 1).over(rule_order)
    # the words before a match: one blank stands before every word of the pieces and matches so far
    placed = pieces.repartition("row_id").select(
        "row_id", "rule", "label", "priority", "confidence", "base", (seen - length).cast("long").alias("start"),
        length.cast("long").alias("n"),
    ).withColumn("end", F.col("start") + F.col("n"))
    order = Window.partitionBy("row_id").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = {p: F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before) for p in PRIORITIES}
    own = reduce(lambda rest, p: F.when(F.col("priority") == p, reach[p]).otherwise(rest), PRIORITIES, F.lit(None))
    kept = F.col("base") | ~F.coalesce(own >= F.col("end"), F.lit(False))
    return placed.select("*", kept.alias("kept")).drop("n")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: word count, base places, base labels, all kept labels and a score.

    The score is the largest confidence among the kept detections, 0 without any.
    """
    rows = scanned(docs, key, text)
    base = F.col("base")
    joined = lambda condition: F.array_join(
        F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ","
    )
    found = detections(rows).groupBy("row_id").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("kept")).alias("labels"),
        F.max(F.when(F.col("kept"), F.col("confidence"))).alias("score"),
    )
    return rows.drop("words").join(found, "row_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
