"""Phrase collocations by set-oriented mining over sorted occurrence relations.

Texts are lower-cased (A-Z), cut into pieces and words. The first relation holds every word
occurrence, sorted by piece and position: words of a piece have consecutive places and a new piece
leaves a gap, so the next position of the same piece is `place + 1`. One step of the mining keeps
the occurrences whose group is frequent (semi-join with the counted groups), joins them by merging
with themselves at the next place (a phrase and the one that starts a word later), which gives the
occurrences of all phrases that are a word longer, and counts those. Every part of a frequent phrase is
frequent, so nothing is lost, and each relation is stored before the next one.

A relation is kept in blocks of consecutive texts, one row per block of about `BLOCK_BYTES` of text:
the sorted places and, for each, the number of its group among the block's own groups. Only
these distinct groups with their counts are shuffled, packed by (block, shard): a hash deals the groups to
shards of about `SHARD_GROUPS`, where they are counted, and the frequent ones return packed
to their blocks. A word or phrase in a third of all texts is thus one entry per block, and the
largest things that a task holds are a shard and a block or a longer text.

A phrase is then cut after each of its words; the cut with the lowest score
floor(1000 * a * n / (l * r)) counts, the earliest of equal ones, in exact decimals. A phrase is dropped
when a longer one that contains it is at least as frequent; that one then contains a phrase just
one word longer of which the same holds, so only those are looked at.

Null text is empty and gives nothing; null lang is `und`, also together with rows that say `und`.
Rows that repeat an id or a text all count. An empty table gives an empty result. Other columns,
doc_id included, are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.common import text_slices, whole
from hazeline.session import stage_table

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
CUT = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")
BLOCK_BYTES = 1 << 23
SHARD_GROUPS = 1 << 19
SLICE_BYTES = 1 << 20
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
SHARES = 64
# groups: how many different ones; parts of `keys` belong to one lang, or to '' from the second level on
RELATION = "block long, occurrences long, relation binary, groups long, langs array<string>, keys array<binary>, times array<binary>"
SHARDS = "shard long, lang string, block long, keys binary, times binary, at binary"
COUNTED = "block long, at binary, gids binary, lang string, word array<string>, a array<long>, gid array<long>, `left` array<long>, `right` array<long>"


def packed(*columns: np.ndarray) -> bytes:
    """64-bit numbers, first all low bytes, then the next ones, compressed."""
    planes = [np.ascontiguousarray(c, dtype="<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(x.T).view("<i8").ravel() for x in raw]


def block_row(number: int, places: np.ndarray, groups: np.ndarray, n: int, parts: list[tuple[str, bytes, np.ndarray]]) -> pa.RecordBatch:
    """A row of `RELATION`; `parts` list the block's groups in the order of their numbers."""
    langs, keys, times = zip(*parts)
    lists = [pa.array([list(langs)], pa.list_(pa.string())), pa.array([list(keys)], pa.list_(pa.binary())),
             pa.array([[packed(t) for t in times]], pa.list_(pa.binary()))]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([len(places)], pa.int64()),
         pa.array([packed(np.diff(places, prepend=0), groups)], pa.binary()), pa.array([n], pa.int64()), *lists],
        names=["block", "occurrences", "relation", "groups", "langs", "keys", "times"],
    )


class Words:
    """The word relation of a block: places and word numbers of each slice."""

    def __init__(self):
        number = count()
        self.known: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(number.__next__))
        self.places, self.words, self.free, self.size = [], [], 0, 0

    def add(self, lang: str, texts: list[str]) -> None:
        data = b"\n".join([t.encode().lower() for t in texts]).translate(CUT)
        signs = np.frombuffer(data, dtype=np.uint8)
        line, blank = signs == 10, (signs == 10) | (signs == 32)
        starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        words = data.split()
        places = self.free + np.arange(len(words)) + np.cumsum(line)[starts]
        self.size += len(data)
        if len(words):
            self.places.append(places)
            self.words.append(np.array(list(map(self.known[lang].__getitem__, words)), dtype=np.int64))
            self.free = int(places[-1]) + 2

    def row(self, number: int) -> pa.RecordBatch:
        places, words = np.concatenate(self.places), np.concatenate(self.words)
        order = [i for known in self.known.values() for i in known.values()]
        new = np.empty(len(order), dtype=np.int64)
        new[order] = np.arange(len(order))
        times, parts, start = np.bincount(new[words], minlength=len(order)), [], 0
        for lang, known in self.known.items():
            joined = zstandard.ZstdCompressor(level=1).compress(b"\n".join(known))
            parts.append((lang, joined, times[start : start + len(known)]))
            start += len(known)
        return block_row(number, places, new[words], len(order), parts)


def word_blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The first relation, stored: every word occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, block = TaskContext.get().partitionId() << 24, Words()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in text_slices(batch.column("text"), SLICE_BYTES):
                by_lang = defaultdict(list)
                for name, t in zip(langs[start : start + len(texts)], texts):
                    by_lang[name].append(t)
                for name, own in by_lang.items():
                    block.add(name, own)
                if block.size >= BLOCK_BYTES:
                    if block.places:
                        yield block.row(number)
                    number, block = number + 1, Words()
        if block.places:
            yield block.row(number)

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole(F.col(text)).alias("text"))
    return stage_table(rows.mapInArrow(run, RELATION), "word-relation")


def longer(blocks: DataFrame, counted: DataFrame) -> DataFrame:
    """The next relation from `blocks` and the rows of `counted` that say which groups are frequent."""

    def advance(block: pa.Table, frequent: pa.Table) -> pa.Table:
        found = [unpacked(a.as_py(), 1) + unpacked(g.as_py(), 1) for a, g in zip(frequent.column("at"), frequent.column("gids"))]
        at, gid = (np.concatenate([x[i] for x in found] or [np.zeros(0, dtype=np.int64)]) for i in (0, 1))
        step, group = unpacked(block.column("relation")[0].as_py(), 2)
        own = np.full(block.column("groups")[0].as_py(), -1, dtype=np.int64)
        own[at] = np.arange(len(at))
        group, place = own[group], np.cumsum(step)
        place, group = place[group >= 0], group[group >= 0]
        # both sides are sorted by place, so the rows of the next place are the next rows
        joined, n = np.flatnonzero(np.diff(place) == 1), max(1, len(at))
        pairs, inverse, times = np.unique(group[joined] * n + group[joined + 1], return_inverse=True, return_counts=True)
        keys = packed(gid[pairs // n], gid[pairs % n]) if len(pairs) else b""
        row = block_row(block.column("block")[0].as_py(), place[joined], inverse, len(pairs), [("", keys, times)])
        return pa.Table.from_batches([row]).slice(0, int(len(pairs) > 0))

    kept = blocks.select("block", "occurrences", "relation", "groups")
    found = counted.filter(F.col("block").isNotNull()).select(F.col("block").alias("of_block"), "at", "gids")
    return stage_table(
        kept.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(advance, RELATION), "phrase-relation"
    )


def shard_rows(blocks: DataFrame, shards: int, words: bool) -> DataFrame:
    """The groups of every block, dealt to shards: keys, times and numbers of each part packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, langs, keys, times in zip(*(batch.column(c) for c in ("block", "langs", "keys", "times"))):
                rows, start = [], 0
                for lang, key, time in zip(langs.as_py(), keys.as_py(), times.as_py()):
                    time = unpacked(time, 1)[0]
                    if words:
                        names = np.array(zstandard.ZstdDecompressor().decompress(key).split(b"\n"), dtype=object)
                        dealt = np.array([zlib.crc32(w) for w in names]) % shards
                    else:
                        left, right = unpacked(key, 2)
                        dealt = ((left * 0x9E3779B1 + right) * 0x85EBCA77 >> 17) % shards
                    order = np.argsort(dealt, kind="stable")
                    ends = np.cumsum(np.bincount(dealt, minlength=shards)).tolist()
                    for shard, (a, b) in enumerate(zip([0, *ends], ends)):
                        if a < b:
                            at = order[a:b]
                            own = zstandard.ZstdCompressor(level=1).compress(b"\n".join(names[at])) if words else packed(left[at], right[at])
                            rows.append((shard, lang, block.as_py(), own, packed(time[at]), packed(at + start)))
                    start += len(time)
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["shard", "lang", "block", "keys", "times", "at"]
                )

    return blocks.select("block", "langs", "keys", "times").mapInArrow(run, SHARDS)


def counted_groups(blocks: DataFrame, min_count: int, words: bool) -> DataFrame:
    """Stored rows of `COUNTED`: with `block`, the numbers of its frequent groups and their gids; without
    it, the frequent groups of a shard. Gids are small: the place in the shard, then the shard."""
    total = blocks.agg(F.sum("groups").alias("n")).first()["n"] or 0
    shards = -(-total // SHARD_GROUPS) or 1

    def count_part(rows: pa.Table, shard: int, lang: str, taken: int) -> tuple[list[tuple], int]:
        """Rows of `COUNTED` for one lang of a shard, of which `taken` numbers are in use."""
        keys, at = rows.column("keys").to_pylist(), [unpacked(x, 1)[0] for x in rows.column("at").to_pylist()]
        times = np.concatenate([unpacked(x, 1)[0] for x in rows.column("times").to_pylist()])
        if words:
            plain = zstandard.ZstdDecompressor().decompress
            names = pa.array([w for k in keys for w in plain(k).split(b"\n")], pa.binary())
            group = names.dictionary_encode().indices.to_numpy().astype(np.int64)
        else:
            pairs = [unpacked(k, 2) for k in keys]
            left, right = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
            order = np.lexsort((right, left))
            new = np.concatenate([[True], (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)])
            group = np.empty(len(left), dtype=np.int64)
            group[order] = np.cumsum(new) - 1
        a = np.bincount(group, weights=times).astype(np.int64)  # exact below 2**53
        kept = np.flatnonzero(a >= min_count)
        number = np.full(len(a), -1, dtype=np.int64)
        number[kept] = (np.arange(len(kept)) + taken) * shards + shard
        gid, start, out = number[group], 0, []
        for block, own_at in zip(rows.column("block").to_pylist(), at):
            own = gid[start : start + len(own_at)]
            start += len(own_at)
            if (own >= 0).any():
                out.append((block, packed(own_at[own >= 0]), packed(own[own >= 0]), *[None] * 6))
        if len(kept):
            first = np.unique(group, return_index=True)[1][kept]
            listed = [w.decode() for w in names.take(pa.array(first)).to_pylist()] if words else None
            sides = (None, None) if words else (left[first], right[first])
            out.append((None, None, None, lang, listed, a[kept], number[kept], *sides))
        return out, taken + len(kept)

    def count_shard(key: tuple, rows: pa.Table) -> pa.Table:
        out, taken = [], 0
        for lang in pc.unique(rows.column("lang")).to_pylist():
            part = rows.filter(pc.equal(rows.column("lang"), lang))
            more, taken = count_part(part, key[0].as_py(), lang, taken)
            out += more
        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.list_(pa.string()), longs, longs, longs, longs]
        names = ["block", "at", "gids", "lang", "word", "a", "gid", "left", "right"]
        columns = list(zip(*out)) or [[]] * len(kinds)
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    rows = shard_rows(blocks, shards, words)
    return stage_table(rows.groupBy("shard").applyInArrow(count_shard, COUNTED), "counted-groups")


def word_totals(blocks: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, times in zip(batch.column("langs").to_pylist(), batch.column("times").to_pylist()):
                sums = [int(unpacked(t, 1)[0].sum()) for t in times]
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sums, pa.int64())], names=["lang", "n"])

    sums = blocks.select("langs", "times").mapInArrow(run, "lang string, n long")
    return stage_table(sums.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, list[DataFrame]]:
    """(totals, levels): (lang, n) with all word occurrences, and for 1 to `max_words` words the stored
    (lang, phrase, a, gid) of the frequent phrases, from the second on with `left` and `right`, the
    gids of the phrase without its last and its first word."""
    blocks = word_blocks(docs, text, lang)
    totals = word_totals(blocks)
    counted = counted_groups(blocks, min_count, words=True)
    listed = lambda *names: counted.filter(F.col("block").isNull()).select(
        "lang", F.explode(F.arrays_zip(*names, "a", "gid")).alias("g")
    ).select("lang", "g.*")
    levels = [stage_table(listed("word").withColumnRenamed("word", "phrase"), "frequent-words")]
    for _ in range(1, max_words):
        blocks = longer(blocks, counted)
        counted = counted_groups(blocks, min_count, words=False)
        first = levels[-1].select(F.col("gid").alias("left"), "lang", F.col("phrase").alias("head"))
        last = levels[-1].select(F.col("gid").alias("right"), F.substring_index("phrase", " ", -1).alias("tail"))
        named = listed("left", "right").drop("lang").join(first, "left").join(last, "right").select(
            "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "a", "gid", "left", "right"
        )
        levels.append(stage_table(named, "frequent-phrases"))
    return totals, levels


def without_absorbed(levels: list[DataFrame], percent: int) -> list[DataFrame]:
    """(lang, phrase, a) of the phrases of two and more words that no longer one stands for."""
    kept = []
    for level, above in zip(levels[1:], [*levels[2:], None]):
        if above is not None:
            held = above.select(F.explode(F.array("left", "right")).alias("gid"), F.col("a").alias("longer"))
            held = held.groupBy("gid").agg(F.max("longer").alias("longer"))
            level = level.join(held, "gid", "left").filter(
                F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
            )
        kept.append(level.select("lang", "phrase", "a"))
    return kept


def exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, percent: int = 100,
    text: str = "text", lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each lang.

    The best of each of `SHARES` shares of a lang are found first, so that no task ranks all phrases
    of one lang. With a, n below 10**17 the products fit 38 digits.
    """
    totals, levels = frequent_phrases(docs, min_count, max_words, text, lang)
    counts = reduce(DataFrame.unionByName, [x.select("lang", "phrase", "a") for x in levels])
    kept = reduce(DataFrame.unionByName, without_absorbed(levels, percent))
    words, k = F.split("phrase", " "), F.col("k")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice(words, k + 1, F.size(words) - k), " ").alias("rest"),
    )
    part = lambda name, number: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(number))
    both = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    product = (exact("a") * exact("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    scored = both.withColumn("product", product).withColumn("parts", exact("l") * exact("r"))
    cut = F.min(F.struct(F.expr("product div parts").alias("score"), "k", "l", "r")).alias("cut")
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(cut).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    near = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    best = lowest.withColumn("share", share).withColumn("near", near).filter(F.col("near") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return best.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
