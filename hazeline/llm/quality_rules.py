"""Quality rules with cross-document line frequency, in DataFrame operations only.

Base rules look at one text: too few words, or too many of its words inside eight-word windows
that occur again. The second rule looks across documents: lines are normalised (lower case, single
blanks) and hashed; a line's frequency is the number of distinct texts of its host
that carry it, so exact copies count once. Lines above both limits (a number of texts and a share
of the host's texts) are boilerplate and are removed; a document of which too small a share of
words is left is depleted and rejected. Repeated lines count once in that share. One text per line, its
owner, keeps it, so that a passage does not vanish with its copies: the smallest digest among the
texts that pass the base rules and would have enough left without all their frequent lines, or,
where a line has no such text, among all that pass the base rules. An owner is never depleted. `judged` and
`keep_good` give the verdicts, `clean_good` also cuts the lines from the texts that stay. The base
rules look at the text before the cut.

The verdict depends on host and text alone, so copies and rows that repeat an id share it. Null
text is empty and fails the base rules. Null hosts are one host. A line may be in a third of all
documents: counts are summed before the shuffle, and the frequent lines meet their occurrences in
a join of two stored tables, which Spark can split. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import WHITE, WHITE_RUN, let, split_words, whole
from hazeline.session import stage_table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
MAX_LINE_TEXTS = 20
MAX_LINE_SHARE = 0.005
MIN_LEFT_SHARE = 0.2
ODD_BLANKS = ("  ", "\t", "\x0b", "\x0c", "\r")


def window_hashes(words: Column) -> Column:
    """Hash of every window of eight consecutive words; none in shorter texts."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    follow = lambda a: F.transform(a, lambda x, i: F.xxhash64(x, *[F.get(a, i + k) for k in range(1, WINDOW)]))
    return F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.slice(let(hashed, follow), 1, F.size(words) - (WINDOW - 1))
    )


def repeat_words(words: Column) -> Column:
    """Number of words inside eight-word windows found twice or more.

    Only texts with a repeated window sort their windows; then the covered stretches of the sorted
    positions are summed.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def starts(s: Column) -> Column:
            again = lambda x, i: (
                F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            )
            return F.sort_array(F.transform(F.filter(s, again), lambda x: x["at"]))

        def total(at: Column) -> Column:
            first = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
            step = lambda acc, p: F.struct(
                (p + WINDOW).alias("end"), (acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n")
            )
            return F.aggregate(at, first, step)["n"]

        return total(let(placed, starts))

    return let(window_hashes(words), lambda w: F.when(
        F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")
    ).otherwise(covered(w)))


def plain_words(text: Column) -> Column:
    """`split_words`, with a plain split where words stand apart by single blanks or line ends."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    odd = [F.contains(flat, F.lit(x)) for x in ODD_BLANKS]
    odd += [F.startswith(flat, F.lit(" ")), F.endswith(flat, F.lit(" ")), flat == ""]
    return F.when(reduce(lambda a, b: a | b, odd), split_words(text)).otherwise(F.split(flat, " "))


def line_entry(line: Column) -> Column:
    """(line, words): hash of the normalised line and its number of words."""
    odd = reduce(lambda a, b: a | b, [F.contains(line, F.lit(x)) for x in ODD_BLANKS])
    plain = F.btrim(F.lower(F.when(odd, F.regexp_replace(line, WHITE_RUN, " ")).otherwise(line)), F.lit(WHITE))
    blanks = lambda x: F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit("")))
    return let(plain, lambda x: F.struct(F.xxhash64(x).alias("line"), (blanks(x) + 1).alias("words")))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: (doc_id, host, page, the base counts, base_failed, lines); texts are read once."""
    raw = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"),
        whole(F.col(text)).alias("text"),
    )
    has_word = lambda line: F.btrim(line, F.lit(WHITE)) != ""
    parts = raw.select(
        "*", plain_words(F.col("text")).alias("w"), F.filter(F.split("text", "\n", -1), has_word).alias("l")
    )
    symbols = f"[{SYMBOLS}]"
    counted = parts.select(
        "doc_id",
        "host",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("page"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.when(F.col("text").rlike(symbols), F.length("text") - F.length(F.regexp_replace("text", symbols, "")))
        .otherwise(0).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        F.transform("l", line_entry).alias("lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def frequent_lines(
    occurrences: DataFrame, max_texts: int = MAX_LINE_TEXTS, max_share: float = MAX_LINE_SHARE
) -> DataFrame:
    """(host, line, n_texts) of the lines above both limits."""
    pages = occurrences.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(
        F.count(F.lit(1)).alias("host_texts")
    )
    counts = occurrences.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_texts"))
    above = counts.filter(F.col("n_texts") > max_texts).join(pages, "host")
    return above.filter(F.col("n_texts") > max_share * F.col("host_texts")).select("host", "line", "n_texts")


def cut_pages(rows: DataFrame, min_left: float = MIN_LEFT_SHARE, **limits) -> DataFrame:
    """(host, page, kept_share, depleted, gone) of the texts that hold frequent lines; `gone` has the
    hashes of those that they lose."""
    lines = rows.select("host", "page", "base_failed", F.explode("lines").alias("l"))
    seen = lines.select("host", "page", "base_failed", "l.line", "l.words").groupBy("host", "line", "page")
    seen = stage_table(seen.agg(F.max("words").alias("words"), F.max("base_failed").alias("failed")), "line-occurrences")
    frequent = stage_table(frequent_lines(seen, **limits), "frequent-lines")
    hit = F.when(F.col("n_texts").isNotNull(), F.struct("line", "words"))
    held = seen.join(frequent, ["host", "line"], "left").groupBy("host", "page").agg(
        F.sum("words").alias("all_words"), F.max("failed").alias("failed"), F.collect_list(hit).alias("hits")
    )
    held = stage_table(held.filter(F.size("hits") > 0), "pages-with-frequent-lines")
    share = lambda words: 1 - words / F.col("all_words")
    bare = share(F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["words"]))
    good = held.filter(~F.col("failed")).select("host", "page", (bare >= min_left).alias("sturdy"), F.explode("hits.line").alias("line"))
    owners = good.groupBy("host", "line").agg(
        F.coalesce(F.min(F.when(F.col("sturdy"), F.col("page"))), F.min("page")).alias("owner")
    )
    listed = held.select("host", "page", "all_words", F.explode("hits").alias("h")).select("host", "page", "all_words", "h.*")
    found = listed.join(stage_table(owners, "line-owners"), ["host", "line"], "left")
    owned = F.coalesce(F.col("owner") == F.col("page"), F.lit(False))
    left = found.groupBy("host", "page", "all_words").agg(
        F.sum(F.when(owned, 0).otherwise(F.col("words"))).alias("gone_words"), F.max(owned).alias("owns"),
        F.collect_list(F.when(~owned, F.col("line"))).alias("gone"),
    )
    kept_share = share(F.col("gone_words"))
    return left.select(
        "host", "page", kept_share.alias("kept_share"), (~F.col("owns") & (kept_share < min_left)).alias("depleted"), "gone"
    )


def depleted_pages(rows: DataFrame, **limits) -> DataFrame:
    """(host, page, kept_share) of the texts that removal of frequent lines depletes."""
    return cut_pages(rows, **limits).filter("depleted").select("host", "page", "kept_share")


def without_lines(text: Column, gone: Column) -> Column:
    """`text` without the lines whose hash is in `gone`.

    The hashes are dealt to as many buckets as the square root of their number, so that a text of
    many lines does not search all of them for each line.
    """
    n = F.ceil(F.sqrt(F.size(gone))).cast("int")
    buckets = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.filter(gone, lambda h: F.pmod(h, n) == b))
    stays = lambda at: lambda line: (F.btrim(line, F.lit(WHITE)) == "") | ~let(
        line_entry(line)["line"], lambda h: F.array_contains(F.get(at, F.pmod(h, n).cast("int")), h)
    )
    return F.array_join(let(buckets, lambda at: F.filter(F.split(text, "\n", -1), stays(at))), "\n")


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """Every row with its base counts and the verdict `kept`."""
    rows = stage_table(features(docs, key, text, host), "quality-features")
    depleted = stage_table(depleted_pages(rows, **limits), "depleted-pages")
    verdict = rows.drop("lines").join(depleted, ["host", "page"], "left")
    kept = ~F.col("base_failed") & F.col("kept_share").isNull()
    return verdict.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), F.coalesce("kept_share", F.lit(1.0)).alias("kept_share"),
    )


def page_key(page: Column, host: Column) -> Column:
    return F.concat(page, host.cast("binary"))


def with_own_key(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(rec, _own_key): the whole row and the key of its text and host."""
    host_ = F.coalesce(F.concat(F.lit("="), F.col(f"rec.`{host}`").cast("string")), F.lit(""))
    page = F.unhex(F.md5(whole(F.col(f"rec.`{text}`")).cast("binary")))
    return docs.select(F.struct("*").alias("rec")).select("rec", page_key(page, host_).alias("_own_key"))


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """`docs` without rejected rows; the rest keeps its columns and whole texts."""
    rows = stage_table(features(docs, key, text, host), "quality-features")
    failed = rows.filter("base_failed").select("host", "page")
    lost = failed.unionByName(depleted_pages(rows, **limits).select("host", "page")).distinct()
    lost = stage_table(lost.select(page_key(F.col("page"), F.col("host")).alias("_lost_key")), "rejected-pages")
    left = with_own_key(docs, text, host)
    return left.join(lost, F.col("_own_key") == F.col("_lost_key"), "left_anti").select("rec.*")


def clean_good(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", **limits
) -> DataFrame:
    """`docs` without rejected rows and, in the rest, without frequent lines.

    The rows are those of `keep_good`. Texts without frequent lines stay as they are and owners keep
    the lines that they own; so do all other columns, also lengths that were taken from the whole text.
    """
    rows = stage_table(features(docs, key, text, host), "quality-features")
    none = F.array().cast("array<bigint>")
    failed = rows.filter("base_failed").select("host", "page").distinct()
    failed = failed.select("host", "page", F.lit(True).alias("lost"), none.alias("gone"))
    cut = cut_pages(rows, **limits).select(
        "host", "page", F.col("depleted").alias("lost"), F.when(F.col("depleted"), none).otherwise(F.col("gone")).alias("gone")
    )
    pages = failed.unionByName(cut).groupBy("host", "page").agg(
        F.max("lost").alias("_lost"), F.flatten(F.collect_list("gone")).alias("_gone")
    )
    marks = pages.select(page_key(F.col("page"), F.col("host")).alias("_mark_key"), "_lost", "_gone")
    left = with_own_key(docs, text, host)
    found = left.join(stage_table(marks, "page-marks"), F.col("_own_key") == F.col("_mark_key"), "left")
    name = f"`{text}`"
    shorter = F.col("rec").withField(name, without_lines(F.col(f"rec.{name}"), F.col("_gone")))
    kept = found.filter(~F.coalesce("_lost", F.lit(False)))
    return kept.select(F.when(F.size("_gone") > 0, shorter).otherwise(F.col("rec")).alias("rec")).select("rec.*")
