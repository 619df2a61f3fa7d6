"""Language identification by Bayesian evidence fusion.

A page's log-odds add up three sources: the likelihood of its text under byte-trigram profiles
learnt from all labelled documents, the markup language it declares, and a prior of its host. The
host's prior is smoothed towards its domain's, that towards its address suffix's, and that towards
all pages'; the counts of every level are sums of the text-only posteriors over grouped pages, and
a page's own share is taken out before it is judged. How far declarations can be trusted is
estimated from the same posteriors.

Text counts as at most `TEXT_TRIGRAMS` independent trigrams. Pages without text, address or
declaration lack that source only (null is such a value). Null language labels are not learnt.
Pages that repeat an id are judged one by one. A host may have a third of all pages: level sums are
pre-aggregated, and pages meet them in a join of stored tables. Without labelled documents there
are no languages and the result has null languages; without pages it is empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import text_slices, whole
from hazeline.session import stage_table

BINS = 1 << 14
SLICE_BYTES = 1 << 21
TEXT_TRIGRAMS = 60.0
STRENGTH = 4.0
SMOOTH = 0.5
MAX_LANGUAGES = 256
MARKUP = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"


def trigrams(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams of the lower-cased text, white space as one blank."""
    raw = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode(), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(BINS, dtype=np.int64)
    codes = (raw[:-2] * 0x9E3779B1 + raw[1:-1] * 0x85EBCA6B + raw[2:] * 0xC2B2AE35).astype(np.uint32)
    return np.bincount(codes >> np.uint32(18), minlength=BINS)


def profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log trigram probabilities, from every labelled document.

    Tasks send one row per language and bin; the driver gets at most MAX_LANGUAGES x BINS sums.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang_, text_ in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found = trigrams(text_.as_py())
                totals[lang_] = totals[lang_] + found if lang_ in totals else found
        for lang_, found in totals.items():
            bins = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang_] * len(bins)), pa.array(bins), pa.array(found[bins])], names=["lang", "bin", "n"]
            )

    rows = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), whole(F.col(text)).alias("text")
    )
    sums = stage_table(
        rows.mapInArrow(counted, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")),
        "language-profiles",
    )
    names = sorted(r["lang"] for r in sums.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError("too many languages")
    counts, place = np.zeros((len(names), BINS)), {name: i for i, name in enumerate(names)}
    for row in sums.toLocalIterator():
        counts[place[row["lang"]], row["bin"]] = row["n"]
    return names, np.log((counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * BINS))


def address_parts(url: Column) -> list[Column]:
    """host, domain (last two labels) and suffix (last label); empty without an address."""
    host = F.lower(F.regexp_extract(whole(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    domain = F.when(domain == "", host).otherwise(domain)
    return [host.alias("host"), domain.alias("domain"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix")]


def evidence(pages: DataFrame, names: Sequence[str], table: np.ndarray, key: str, url: str, html: str) -> DataFrame:
    """(page_id, host, domain, suffix, declared, text_log, q): q is the text-only posterior."""
    declared = F.lower(F.regexp_extract(
        whole(F.col(html)), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-zA-Z]{2,8})""", 1
    ))
    rows = pages.select(
        F.col(key).alias("page_id"), *address_parts(F.col(url)), declared.alias("declared"),
        F.regexp_replace(whole(F.col(html)), MARKUP, " ").alias("text"),
    )

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch.column("text"), SLICE_BYTES):
                logs, sizes = np.zeros((len(texts), len(names))), np.zeros(len(texts))
                for i, text in enumerate(texts):
                    found = trigrams(text)
                    logs[i], sizes[i] = table @ found, found.sum()
                logs *= np.minimum(1.0, TEXT_TRIGRAMS / np.maximum(sizes, 1.0))[:, None]
                logs -= logs.max(axis=1, keepdims=True)
                q = np.exp(logs)
                q /= q.sum(axis=1, keepdims=True)
                names_ = ("page_id", "host", "domain", "suffix", "declared")
                columns = {n: batch.column(n).slice(start, len(texts)) for n in names_}
                yield pa.RecordBatch.from_pydict({**columns, "text_log": logs.tolist(), "q": q.tolist()}, schema=schema)

    schema = pa.schema([
        ("page_id", pa.int64()), ("host", pa.string()), ("domain", pa.string()), ("suffix", pa.string()),
        ("declared", pa.string()), ("text_log", pa.list_(pa.float64())), ("q", pa.list_(pa.float64())),
    ])
    return rows.withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(
        likelihood,
        "page_id long, host string, domain string, suffix string, declared string, "
        "text_log array<double>, q array<double>",
    )


def summed(rows: DataFrame, by: Sequence[str], n: int, name: str) -> DataFrame:
    """Element sums of `q` per group as the array `name`."""
    sums = rows.groupBy(*by).agg(*[F.sum(F.get("q", F.lit(i))).alias(f"_s{i}") for i in range(n)])
    return sums.select(*by, F.array(*[f"_s{i}" for i in range(n)]).alias(name))


def identified(
    pages: DataFrame, docs: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, lang, probability, declared, host) for every page."""
    names, table = profiles(docs)
    if not names:
        none = pages.select(F.col(key).cast("long").alias("page_id"), F.lit(None).cast("string").alias("lang"))
        return none.select("*", F.lit(0.0).alias("probability"), F.lit("").alias("declared"), F.lit("").alias("host"))
    n = len(names)
    rows = stage_table(evidence(pages, names, table, key, url, html), "page-evidence")
    hosts = summed(rows, ["host", "domain", "suffix"], n, "host_q")
    hosts = stage_table(hosts, "host-counts")
    domains = summed(hosts.withColumnRenamed("host_q", "q"), ["domain", "suffix"], n, "domain_q")
    suffixes = summed(domains.withColumnRenamed("domain_q", "q"), ["suffix"], n, "suffix_q")
    levels = stage_table(hosts.join(domains, ["domain", "suffix"]).join(suffixes, "suffix"), "host-levels")
    trust = summed(rows, ["declared"], n, "declared_q")
    n_declared = trust.count()
    total = suffixes.agg(*[F.coalesce(F.sum(F.get("suffix_q", F.lit(i))), F.lit(0.0)) for i in range(n)]).first()
    all_q = F.array(*[F.lit(float(t)) for t in total])

    minus = lambda a: F.zip_with(a, F.col("q"), lambda x, y: F.greatest(x - y, F.lit(0.0)))
    size = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def smoothed(counts: Column, prior: Column) -> Column:
        return F.zip_with(counts, prior, lambda c, p: (c + STRENGTH * p) / (size(counts) + STRENGTH))

    met = rows.join(levels.select("host", "host_q", "domain_q", "suffix_q"), "host").join(trust, "declared")
    met = met.select(
        "page_id", "host", "declared", "text_log", "q", minus(all_q).alias("a"), minus(F.col("suffix_q")).alias("s"),
        minus(F.col("domain_q")).alias("d"), minus(F.col("host_q")).alias("h"), minus(F.col("declared_q")).alias("t"),
    )
    uniform = F.transform("a", lambda c: (c + SMOOTH) / (size(F.col("a")) + SMOOTH * n))
    met = met.withColumn("p", uniform)
    for level in ("s", "d", "h"):
        met = met.withColumn("p", smoothed(F.col(level), F.col("p")))
    says = F.zip_with("t", "a", lambda t, a: F.log((t + SMOOTH) / (a + SMOOTH * (n_declared + 1))))
    logs = F.zip_with(
        F.zip_with("text_log", "p", lambda x, p: x + F.log(p)), F.when(F.col("declared") == "", F.transform("a", lambda a: F.lit(0.0))).otherwise(says), lambda x, y: x + y
    )
    met = met.withColumn("logs", logs).withColumn("best", F.array_max("logs"))
    weight = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.col("best"))), F.lit(0.0), lambda s, x: s + x)
    chosen = F.element_at(F.array(*[F.lit(x) for x in names]), F.array_position("logs", F.col("best")).cast("int"))
    return met.select(
        "page_id", chosen.alias("lang"), (1 / weight).alias("probability"), "declared", "host"
    )
