"""Two tokenizers over the same texts, aligned by byte offsets; each distinct text is done once.

A is a byte-level merge file and encodes a blank and the text, B a SentencePiece model that adds
the blank itself. Where a token of A and one of B end at the same byte, a group ends. Two tokens
are linked where their byte ranges overlap: between two neighbouring ends of either side lies just
one such overlap, so the links of a text are the merged list of ends. A pair of ids counts one per
document that holds it linked, corpus-wide.

The documents are shuffled by their full text, combined before the shuffle, so thousands of copies
arrive as one row with a number. Consecutive texts of a task form a block of about `BLOCK_BYTES`;
its links are stored as numbers of the block's own distinct pairs. Only those distinct pairs, with
the documents that hold them, are shuffled to be counted; the counts come back to the block by a
join on the pair and one on the block, and the measures reach the documents by the text's SHA-256.
A block is the largest thing that a task holds, besides a text longer than it.

Null and empty texts, and texts that either side does not give back byte for byte, have no tokens:
their measures are zero and `groups_sha256` is ''. Special tokens written out in a text are plain
text. Every row gets its measures, also rows that repeat an id or a text; copies count as the
documents they are. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm import bpe
from hazeline.llm.common import text_digest, text_slices, whole
from hazeline.session import stage_table

MARK = "▁"
BLOCK_BYTES = 1 << 24
SLICE_BYTES = 1 << 20
B_BITS = 20  # a pair of ids is one number: a * 2**B_BITS + b
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = (
    "block long, digest array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<binary>, distinct array<long>, links binary, pairs array<long>, docs array<long>"
)


class Aligned(NamedTuple):
    """Kept texts of a slice: tokens and links of all of them in a row, with numbers per text."""

    kept: np.ndarray
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_text: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    order: np.ndarray  # entries of `names` that spell the groups


def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(lengths.sum())), lengths


class Aligner:
    """Both encoders and the alignment of a slice of texts."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = bpe.encoder(a_path, special=False), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [self.a.surface.get(i, b"") for i in range(self.a.size())]
        pieces = range(self.b.vocab_size())
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace(MARK, " ").encode()
            for i in pieces
        ]
        if len(self.b_bytes) > 1 << B_BITS:
            raise ValueError(f"more than {1 << B_BITS} pieces")
        self.names = [f"{i}{end}".encode() for i in range(len(self.a_bytes)) for end in ",|"]
        self.names += [f"{i}{end}".encode() for i in pieces for end in ",;"]
        self.a_length = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    @staticmethod
    def same(raw: list[bytes], ids: list[list[int]], surface: list[bytes]) -> list[bool]:
        """Which texts the ids' bytes spell."""
        return [b"".join([surface[i] for i in x]) == r for x, r in zip(ids, raw)]

    def align(self, texts: list[str]) -> Aligned:
        spaced = [" " + t for t in texts]
        raw = [t.encode() for t in spaced]
        ids_a, ids_b = self.a.encode(spaced), self.b.encode(texts, num_threads=1)
        kept = np.array(self.same(raw, ids_a, self.a_bytes)) & np.array(self.same(raw, ids_b, self.b_bytes))
        kept &= np.array([bool(t) for t in texts])
        kept = np.flatnonzero(kept)
        a, n_a = flat([ids_a[i] for i in kept])
        b, n_b = flat([ids_b[i] for i in kept])
        text_end = np.cumsum([len(raw[i]) for i in kept], dtype=np.int64)
        # bit 1: a token of A ends at this byte, bit 2: one of B does
        ends = np.zeros(int(text_end[-1]) + 1 if len(kept) else 1, dtype=np.uint8)
        ends[np.cumsum(self.a_length[a])] = 1
        ends[np.cumsum(self.b_length[b])] |= 2
        at = np.flatnonzero(ends)
        in_a, in_b = (ends[at] & 1).astype(np.int64), (ends[at] >> 1).astype(np.int64)
        both = in_a & in_b
        link_text = np.searchsorted(text_end, at)
        group = np.cumsum(both) - both
        group_a, group_b = group[in_a > 0], group[in_b > 0]
        last_a, last_b = both[in_a > 0], both[in_b > 0]
        groups = int(both.sum())
        b_ends, a_ends = np.cumsum(np.bincount(group_b, minlength=groups)), np.cumsum(np.bincount(group_a, minlength=groups))
        b_starts = np.concatenate([[0], b_ends[:-1]]).astype(np.int64)
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + b_starts[group_a]] = 2 * a + last_a
        order[np.arange(len(b)) + a_ends[group_b]] = 2 * len(self.a_bytes) + 2 * b + last_b
        return Aligned(
            kept, a, b, n_a, n_b,
            np.bincount(link_text[both > 0], minlength=len(kept)), np.bincount(link_text, minlength=len(kept)),
            link_text, a[np.cumsum(in_a) - in_a], b[np.cumsum(in_b) - in_b], order,
        )

    def spelled(self, found: Aligned) -> list[bytes]:
        """The groups of each kept text, as `a1,a2|b1;a3|b2,b3`."""
        stops = np.cumsum(found.n_a + found.n_b).tolist()
        listed, names = found.order.tolist(), self.names
        return [b"".join([names[i] for i in listed[a:b]])[:-1] for a, b in zip([0, *stops], stops)]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def pressed(*columns: np.ndarray) -> bytes:
    """32-bit numbers, first all low bytes, then the next ones, compressed."""
    planes = [np.ascontiguousarray(c, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpressed(data: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    rows = raw.reshape(len(raw) // (4 * n), 4, n) if n else raw.reshape(0, 4, 0)
    return [np.ascontiguousarray(r.T).view("<u4").ravel().astype(np.int64) for r in rows]


class Block:
    """Texts with their links, until they are written as one row."""

    def __init__(self):
        self.texts = {name: [] for name in ("digest", "n_docs", *MEASURES, "groups", "distinct")}
        self.pairs, self.times, self.size = [], [], 0

    def add(self, texts: list[str], n_docs: np.ndarray, tool: Aligner) -> None:
        found = tool.align(texts)
        own, times = np.unique(
            (found.link_text << (B_BITS + 20)) | (found.link_a << B_BITS) | found.link_b, return_counts=True
        )
        self.pairs.append(own & ((1 << (B_BITS + 20)) - 1))
        self.times.append(times)
        self.texts["distinct"] += np.bincount(own >> (B_BITS + 20), minlength=len(found.kept)).tolist()
        self.texts["digest"] += [hashlib.sha256(texts[i].encode()).digest() for i in found.kept.tolist()]
        self.texts["n_docs"] += n_docs[found.kept].tolist()
        self.texts["groups"] += [hashlib.sha256(x).digest() for x in tool.spelled(found)]
        for name in MEASURES:
            self.texts[name] += getattr(found, name).tolist()
        self.size += sum(map(len, texts))

    def row(self, number: int) -> pa.RecordBatch:
        """Each text's pairs as rising numbers of the block's pairs, the frequent ones first, as steps."""
        distinct = np.array(self.texts["distinct"], dtype=np.int64)
        pairs, inverse, often = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        by_frequency = np.argsort(-often, kind="stable")
        rank = np.empty_like(by_frequency)
        rank[by_frequency] = np.arange(len(rank))
        text_of = np.repeat(np.arange(len(distinct)), distinct)
        placed = text_of * len(pairs) + rank[inverse]
        order = np.argsort(placed)
        code = placed[order] - text_of * len(pairs)
        step = np.diff(code, prepend=0)
        first = (np.cumsum(distinct) - distinct)[distinct > 0]
        step[first] = code[first]
        docs = np.bincount(code, weights=np.array(self.texts["n_docs"])[text_of], minlength=len(pairs)).astype(np.int64)
        long = lambda name: pa.array([self.texts[name]], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([self.texts["digest"]], pa.list_(pa.binary())),
             *map(long, MEASURES), pa.array([self.texts["groups"]], pa.list_(pa.binary())), long("distinct"),
             pa.array([pressed(step, np.concatenate(self.times)[order])], pa.binary()),
             pa.array([pairs[by_frequency]], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64()))],
            names=["block", "digest", *MEASURES, "groups", "distinct", "links", "pairs", "docs"],
        )


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """One row per block of distinct texts, stored; columns as in `BLOCKS`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, tool, block = TaskContext.get().partitionId() << 24, aligner(a_path, b_path), Block()
        for batch in batches:
            counts = batch.column("n_docs").to_numpy()
            for start, texts in text_slices(batch.column("text"), SLICE_BYTES):
                block.add(texts, counts[start : start + len(texts)], tool)
                if block.size >= BLOCK_BYTES:
                    if block.texts["digest"]:
                        yield block.row(number)
                    number, block = number + 1, Block()
        if block.texts["digest"]:
            yield block.row(number)

    own = docs.select(F.col(text).alias("text")).filter(F.col("text") != "")
    distinct = own.groupBy("text").agg(F.count(F.lit(1)).alias("n_docs"))
    return stage_table(distinct.mapInArrow(run, BLOCKS), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n_docs, best): documents that hold a pair linked; best: no pair of its A id has more.

    The window is over the pairs of one A id, at most as many as B has pieces.
    """
    listed = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("p.pairs", "p.docs")
    counts = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n_docs"))
    same_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    return counts.select("pair", "n_docs", (F.col("n_docs") == F.max("n_docs").over(same_a)).alias("best"))


def text_measures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """(digest, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every aligned text."""

    def measure(block: pa.Table, found: pa.Table) -> pa.Table:
        row = {name: block.column(name)[0].values for name in ("digest", *MEASURES, "groups", "distinct")}
        at = found.column("at").to_numpy()
        n_docs, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        n_docs[at], best[at] = found.column("n_docs").to_numpy(), found.column("best").to_numpy().astype(np.int64)
        distinct = row["distinct"].to_numpy()
        stops = np.cumsum(distinct)
        step, times = unpressed(block.column("links")[0].as_py(), int(stops[-1]))
        total = np.cumsum(step)
        before = np.concatenate([[0], total])[stops - distinct]
        code = total - np.repeat(before, distinct)
        summed = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], stops])])
        return pa.Table.from_arrays(
            [row["digest"], *[row[m] for m in MEASURES], pa.array(summed(times * best[code])),
             pa.array(summed(times * n_docs[code])), pa.array([x.hex() for x in row["groups"].to_pylist()])],
            names=["digest", *MEASURES, "n_best", "count_sum", "groups_sha256"],
        )

    pairs = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("at", "pair"))
    found = pairs.join(counts, "pair").select("of_block", "at", "n_docs", "best")
    kinds = ", ".join(f"{m} long" for m in (*MEASURES, "n_best", "count_sum"))
    return blocks.drop("pairs", "docs").groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(
        measure, f"digest binary, {kinds}, groups_sha256 string"
    )


def aligned(
    docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(measures, pairs): one row per row of `docs` with the measures of its text, and (a, b, n_docs,
    best) of every linked pair of ids."""
    blocks = aligned_blocks(docs, a_path, b_path, text)
    counts = stage_table(pair_counts(blocks), "pair-counts")
    texts = stage_table(text_measures(blocks, counts), "text-measures")
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.when(F.col(text) != "", text_digest(F.col(text))).alias("digest"),
    )
    zero = [F.coalesce(F.col(m), F.lit(0).cast("long")).alias(m) for m in (*MEASURES, "n_best", "count_sum")]
    measures = rows.join(texts, "digest", "left").select(
        "doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )
    pairs = counts.select(
        F.shiftright("pair", B_BITS).alias("a"), F.col("pair").bitwiseAND((1 << B_BITS) - 1).alias("b"), "n_docs", "best"
    )
    return measures, pairs


def groups(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, groups): the aligned groups of each text spelled out, '' where it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_path, b_path)
        for batch in batches:
            for start, texts in text_slices(batch.column("text"), SLICE_BYTES):
                found, spelled = tool.align(texts), [""] * len(texts)
                for i, groups_ in zip(found.kept.tolist(), tool.spelled(found)):
                    spelled[i] = groups_.decode()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), pa.array(spelled, pa.string())],
                    names=["doc_id", "groups"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, groups string")
