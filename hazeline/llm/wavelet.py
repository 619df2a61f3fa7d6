"""Token shards as wavelet matrices.

A shard holds the tokens of consecutive documents. Its distinct ids are numbered by falling
frequency; the numbers are stored as bit-planes from the highest bit down, each plane's positions
being the stable partition (zeros first) of the plane above. Ones are counted per 512-bit block,
so one compressed file answers: which token stands at a place, how often a token occurs in a
range, and where its k-th occurrence is.

File layout: magic, header (JSON: tokens, first place, planes, zeros per plane, documents), then
zstd frames of the alphabet, the document ends, and each packed plane. A shard travels as one
binary column, so Spark's committer writes the files and a lost executor leaves no half of one.

Memory of a task is bounded by one shard (about `SHARD_TOKENS` ids, or the longest document).
Null text is empty; every document, also an empty one, ends with the end id. Rows are ordered by
doc_id with null first, rows that repeat an id by their text. An empty table has no shards.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.llm import bpe
from hazeline.llm.common import whole
from hazeline.session import stage_table, work_dir

MAGIC = b"HZWM0001"
SHARD_TOKENS = 1 << 18
BLOCK = 512
END_ID = 1
BATCH_DOCS = 256


class WaveletMatrix:
    """Succinct sequence of numbers below 2**len(planes)."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], alphabet: np.ndarray, size: int):
        self.planes, self.zeros, self.alphabet, self.size = planes, zeros, alphabet, size
        self._directories: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        counts = np.bincount(tokens)
        present = np.flatnonzero(counts)
        alphabet = present[np.argsort(-counts[present], kind="stable")].astype(np.uint32)
        code = np.zeros(len(counts), dtype=np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        code[alphabet] = np.arange(len(alphabet), dtype=code.dtype)
        level, planes, zeros = code[tokens], [], []
        for shift in range(max(1, int(len(alphabet) - 1).bit_length()) - 1, -1, -1):
            ones = (level & level.dtype.type(1 << shift)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            low = level.take(np.flatnonzero(~ones))
            zeros.append(len(low))
            level = np.concatenate([low, level.take(np.flatnonzero(ones))])
        return cls(planes, zeros, alphabet, len(tokens))

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3]) >> (at & 7) & 1

    def _rank(self, plane: int, at: int) -> int:
        """Ones before `at`: the block's directory entry plus the bits left."""
        if plane not in self._directories:
            bits = self.planes[plane]
            padded = np.zeros(-(-len(bits) // (BLOCK // 8)) * (BLOCK // 8), dtype=np.uint8)
            padded[: len(bits)] = bits
            per_block = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
            self._directories[plane] = np.concatenate([[0], np.cumsum(per_block)])
        block = at // BLOCK
        rest = np.unpackbits(self.planes[plane][block * BLOCK // 8 : (at + 7) // 8], bitorder="little")
        return int(self._directories[plane][block]) + int(rest[: at - block * BLOCK].sum())

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) `bit`: a binary search over ranks."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            before = self._rank(plane, middle + 1)
            if (before if bit else middle + 1 - before) > k:
                high = middle
            else:
                low = middle + 1
        return low

    def access(self, at: int) -> int:
        code = 0
        for plane, zeros in enumerate(self.zeros):
            bit, ones = self._bit(plane, at), self._rank(plane, at)
            at = zeros + ones if bit else at - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int, int | None]:
        found = np.flatnonzero(self.alphabet == token)
        if not len(found):
            return 0, 0, None
        code, depth = int(found[0]), len(self.planes)
        for plane, zeros in enumerate(self.zeros):
            first, last = self._rank(plane, start), self._rank(plane, stop)
            if code >> (depth - 1 - plane) & 1:
                start, stop = zeros + first, zeros + last
            else:
                start, stop = start - first, stop - last
        return start, stop, code

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of `token` in [start, stop)."""
        low, high, _ = self._range(token, start, self.size if stop is None else stop)
        return high - low

    def locate(self, token: int, k: int) -> int:
        """Place of the k-th occurrence, from 0; raises IndexError beyond the last."""
        low, high, code = self._range(token, 0, self.size)
        if code is None or not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for plane in range(len(self.planes) - 1, -1, -1):
            bit = code >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """The whole sequence: planes are undone from the lowest up."""
        level = np.zeros(self.size, dtype=np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for shift, (bits, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(bits, count=self.size, bitorder="little").view(bool)
            above = np.empty_like(level)
            above[np.flatnonzero(~ones)] = level[:zeros]
            above[np.flatnonzero(ones)] = level[zeros:] | level.dtype.type(1 << shift)
            level = above
        return self.alphabet[level]


def pack_shard(doc_ids: list, lengths: np.ndarray, tokens: np.ndarray, first: int) -> bytes:
    matrix, press = WaveletMatrix.build(tokens), zstandard.ZstdCompressor(level=1)
    parts = [press.compress(p.tobytes()) for p in (matrix.alphabet, np.cumsum(lengths, dtype=np.uint64), *matrix.planes)]
    header = json.dumps(
        {"size": len(tokens), "first": first, "zeros": matrix.zeros, "docs": doc_ids, "parts": [len(p) for p in parts]}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *parts])


def open_shard(payload: bytes) -> tuple[WaveletMatrix, dict, np.ndarray]:
    """(matrix, header, document ends inside the shard)."""
    if payload[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    at = len(MAGIC) + 4
    size = struct.unpack("<I", payload[len(MAGIC) : at])[0]
    header, at = json.loads(payload[at : at + size]), at + size
    unpack, parts = zstandard.ZstdDecompressor(), []
    for length in header["parts"]:
        parts.append(np.frombuffer(unpack.decompress(payload[at : at + length]), dtype=np.uint8))
        at += length
    matrix = WaveletMatrix(parts[2:], header["zeros"], parts[0].view(np.uint32), header["size"])
    return matrix, header, parts[1].view(np.uint64)


def build_shards(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", partitions: int | None = None
) -> DataFrame:
    """(part, shard, first, n_tokens, payload): shards in ascending doc_id order.

    Rows are ranged by doc_id; each task encodes its range in order and closes a shard when it is
    full. `first` counts the tokens of the part before the shard.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), bpe.encoder(tokenizer)
        state = {"shard": 0, "first": 0}
        ids, chunks, held = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal ids, chunks, held
            lengths = np.array([len(c) for c in chunks], dtype=np.uint64)
            tokens = np.concatenate(chunks)
            payload = pack_shard(ids, lengths, tokens, state["first"])
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "shard": [state["shard"]], "first": [state["first"]], "n_tokens": [len(tokens)],
                 "payload": [payload]},
                schema=pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("first", pa.int64()),
                                  ("n_tokens", pa.int64()), ("payload", pa.binary())]),
            )
            state["shard"], state["first"] = state["shard"] + 1, state["first"] + len(tokens)
            ids, chunks, held = [], [], 0
            return row

        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for start in range(0, len(keys), BATCH_DOCS):
                encoded = coder.encode(texts.slice(start, BATCH_DOCS).to_pylist())
                for doc_id, chunk in zip(keys[start : start + BATCH_DOCS], encoded):
                    ids.append(doc_id)
                    chunks.append(np.array([*chunk, END_ID], dtype=np.uint32))
                    held += len(chunk) + 1
                    if held >= SHARD_TOKENS:
                        yield close()
        if ids:
            yield close()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    order = [F.col("doc_id").asc_nulls_first()]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return ranged.mapInArrow(shards, "part long, shard long, first long, n_tokens long, payload binary")


def write_shards(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    """One uncompressed Parquet file a task: the payloads are compressed already."""
    build_shards(docs, tokenizer, **options).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shard files.

    Parts are numbered in key order, so the tokens before a part are a running sum over one row a
    part; the window has no partition for that reason.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, payload in zip(batch.column("part"), batch.column("first"), batch.column("payload")):
                matrix, header, ends = open_shard(payload.as_py())
                data = memoryview(np.ascontiguousarray(matrix.tokens(), dtype="<u4")).cast("B")
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(starts), pa.int64()), pa.array(header["docs"], pa.int64()),
                     pa.array(starts + first.as_py()), pa.array(ends.astype(np.int64) - starts),
                     pa.array(sums, pa.int64())],
                    names=["part", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage_table(
        totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
        "part-offsets",
    )
    rows = files.select("part", "first", "payload").mapInArrow(
        decode, "part long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return rows.join(offsets, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("inside") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, place): every place of a token, looked up in each shard by rank and select."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                matrix, header, ends = open_shard(payload.as_py())
                places = [matrix.locate(token, k) for k in range(matrix.count(token))]
                docs = np.searchsorted(ends, np.array(places, dtype=np.uint64), side="right")
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([header["docs"][d] for d in docs], pa.int64()),
                     pa.array(np.array(places, dtype=np.int64) - starts[docs], pa.int64())],
                    names=["doc_id", "place"],
                )

    return spark.read.parquet(path).select("payload").mapInArrow(look, "doc_id long, place long")


def encoded_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the shard files under the shared folder and read every document back."""
    path = work_dir(docs.sparkSession, "token-shards")
    write_shards(docs, path, tokenizer, **options)
    return read_documents(docs.sparkSession, path)
