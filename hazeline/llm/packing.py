"""Best-fit packing of token pieces into sequences by minimum bin slack.

Every document becomes its ids and an end id. Documents longer than a sequence are cut into
pieces, of which only the first may be shorter than a sequence; nothing else is cut. Each bin takes
the longest piece left and then the fullest feasible combination of the other lengths: a bitset
holds every sum that the lengths left can reach, and the combination is read back from it. What a
bin took is removed before the next one.

Only counts of lengths matter for that, and they fit on one page whatever the corpus: while the
pieces of a combination last, it stays the fullest one, so it is applied as often as they last in
one step. Each such step leaves a length with fewer pieces than the combination needs of it, so
there are at most a few thousand steps for 1,024 lengths. The pieces then find their bins by
themselves: a piece's number among those of its length (running counts of tasks, summed up over
tasks) says which step, which bin of it and which place it has. No task sees all pieces of a length.

Null text is empty; an empty document is its end id alone. Rows that repeat an id or a text are
packed each for itself. An empty table gives an empty result. Columns other than key and text are
not read. Which of two equally long pieces goes where depends on the order of the input files.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm import bpe
from hazeline.llm.common import text_slices, whole
from hazeline.session import stage_table, work_dir

END_ID = 2
SEQUENCE = 1024
SLICE_BYTES = 1 << 20
PIECES = "part int, nth long, doc_id long, piece int, start long, length int, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, key: str, text: str) -> DataFrame:
    """One row per piece, stored: `ids` as little-endian 32-bit numbers, `nth` the piece's number
    among those of its length in its task `part`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder, seen = TaskContext.get().partitionId(), bpe.encoder(tokenizer), np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            keys = batch.column("doc_id")
            for first, texts in text_slices(batch.column("text"), SLICE_BYTES):
                rows, parts = [], []
                for doc_id, ids in zip(keys.slice(first, len(texts)).to_pylist(), coder.encode(texts)):
                    ids.append(end_id)
                    data, total = np.array(ids, dtype="<u4").tobytes(), len(ids)
                    start = 0
                    for piece in range(-(-total // size)):
                        stop = total - (-(-total // size) - 1 - piece) * size
                        rows.append((doc_id, piece, start, stop - start, seen[stop - start]))
                        seen[stop - start] += 1
                        parts.append(data[4 * start : 4 * stop])
                        start = stop
                ids_, piece, start, length, nth = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.int32()), pa.array(nth, pa.int64()), pa.array(ids_, pa.int64()),
                     pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                     pa.array(parts, pa.binary())],
                    names=["part", "nth", "doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    path = work_dir(docs.sparkSession, "token-pieces")
    cut_rows = rows.mapInArrow(cut, PIECES)
    cut_rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(cut_rows.schema).parquet(path)


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The combination {length: pieces} with the largest sum up to `room`.

    `available` has (length, pieces left) by falling length. Bit s of `reach` says that sum s can
    be reached; a length's pieces come in portions of 1, 2, 4, ... and a rest. Reading back from the
    last portion takes one only where the sum needs it, so short pieces are spared for later bins.
    """
    mask, reach, portions, before = (1 << (room + 1)) - 1, 1, [], []
    for length, left in available:
        count = min(left, room // length)
        size = 1
        while count > 0:
            taken = min(size, count)
            portions.append((length, taken))
            before.append(reach)
            reach |= reach << length * taken & mask
            count, size = count - taken, size * 2
        if reach >> room & 1:
            break
    sum_, used = reach.bit_length() - 1, {}
    for (length, taken), old in zip(reversed(portions), reversed(before)):
        if not old >> sum_ & 1:
            used[length] = used.get(length, 0) + taken
            sum_ -= length * taken
    return used


def plan(counts: Mapping[int, int], size: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """(bins, {length: pieces per bin}) in order of packing, for counts of pieces by length."""
    left, steps = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        longest = max(left)
        rest = [(n, c - (n == longest)) for n, c in sorted(left.items(), reverse=True) if n <= size - longest]
        used = fullest([x for x in rest if x[1] > 0], size - longest)
        used[longest] = used.get(longest, 0) + 1
        bins = min(left[n] // k for n, k in used.items())
        steps.append((bins, used))
        for n, k in used.items():
            left[n] -= k * bins
            if not left[n]:
                del left[n]
    return steps


def ranges(steps: list[tuple[int, dict[int, int]]], size: int) -> dict[int, np.ndarray]:
    """By length, rows (first number, pieces per bin, first bin, offset in the bin)."""
    found, taken, first_bin = {}, [0] * (size + 1), 0
    for bins, used in steps:
        offset = 0
        for length, k in sorted(used.items(), reverse=True):
            found.setdefault(length, []).append((taken[length], k, first_bin, offset))
            taken[length] += k * bins
            offset += length * k
        first_bin += bins
    return {length: np.array(rows, dtype=np.int64) for length, rows in found.items()}


def place(numbered: DataFrame, where: Mapping[int, np.ndarray]) -> DataFrame:
    """`numbered` with sequence_id and offset by (length, number). The map of ranges holds a few
    thousand rows whatever the number of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            ends = list(accumulate(np.bincount(length).tolist()))
            for n in np.unique(length).tolist():
                at, table = order[ends[n - 1] : ends[n]], where[n]
                row = np.searchsorted(table[:, 0], number[at], side="right") - 1
                inside, k = number[at] - table[row, 0], table[row, 1]
                sequence[at] = table[row, 2] + inside // k
                offset[at] = table[row, 3] + inside % k * n
            columns = dict(zip(batch.schema.names, batch.columns)) | {
                "sequence_id": pa.array(sequence), "offset": pa.array(offset)
            }
            columns.pop("number")
            yield pa.RecordBatch.from_pydict(columns)

    kinds = ", ".join(f"{n} {t}" for n, t in numbered.dtypes if n != "number")
    return numbered.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def packed(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, size: int = SEQUENCE, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(placements, pieces).

    `placements` has (part, nth, doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row
    per piece; `pieces` is the stored table of `token_pieces`, joined by (part, length, nth).
    """
    pieces = token_pieces(docs, tokenizer, end_id, size, key, text)
    counts = stage_table(
        pieces.groupBy("part", "length").agg((F.max("nth") + 1).alias("n")), "piece-counts"
    )
    # one row per length: at most `size` rows
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rows = pieces.select(
        "part", "nth", "doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")
    )
    numbered = rows.join(stage_table(before, "piece-starts"), ["part", "length"]).select(
        *rows.columns, (F.col("before") + F.col("nth")).alias("number")
    )
    return place(numbered, ranges(plan(lengths, size), size)), pieces


def sequences(placements: DataFrame, pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, doc_ids, lengths, ids): the packed sequences, ids as little-endian
    32-bit numbers, with the document and length of each piece in order."""
    own = ["part", "length", "nth"]
    found = placements.select(*own, "sequence_id", "offset", "doc_id").join(pieces.select(*own, "ids"), own)
    entries = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    ordered = found.groupBy("sequence_id").agg(entries.alias("e"))
    return ordered.select(
        "sequence_id",
        F.aggregate("e", F.lit(0), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.transform("e", lambda x: x["doc_id"]).alias("doc_ids"),
        F.transform("e", lambda x: x["length"]).alias("lengths"),
        F.aggregate("e", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )
