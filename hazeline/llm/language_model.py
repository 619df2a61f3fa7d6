"""Language-model scoring: word statistics of the whole corpus and a gated recurrent network.

1. Texts become blocks: word codes of consecutive documents and the block's dictionary. Each word
   of a block meets the corpus counts once a block, not once a document.
2. Counts over all training documents give the base score and the model's vocabulary: the most
   frequent words have symbols of their own, the rest fall into classes by their last two code
   points; inside a class a rare word has its smoothed share, so unseen words have one too.
3. Trainers, one per task, learn all training documents once, in rounds. After a round their
   networks are averaged by tokens in a tree of grouped sums; only one network reaches the driver.
4. Scoring carries the network's state over the whole text.

`WORDS`, `CLASSES` and the network's sizes bound the model; counts, training and scoring cover all
documents. Rows are told apart by their place in a block, so repeated ids are scored each. Null
text is empty and has its end only. Without training documents every word has the smoothed share
of nothing seen. An empty table gives an empty result. A text must fit a task's memory; the whole
of it is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import held_out, whole
from hazeline.llm.recurrent import Network, Trainer, score
from hazeline.session import stage_table

WORDS = 1024
CLASSES = 32
ROUNDS = 2
BLOCKS_A_TASK = 2
BLOCK_BYTES = 1 << 24
TRAIN_TOKENS = 1 << 22
CHUNK = 1 << 14
FAN_IN = 32
HELD_OUT = (7, 2)

BLOCK_TYPE = (
    "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, codes binary, "
    "words array<string>, seen array<long>"
)
ENCODED_TYPE = (
    "doc_ids array<long>, held array<boolean>, lengths array<int>, known array<int>, base array<double>, "
    "rare array<double>, symbols binary"
)


def press(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpress(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


class Coding(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def blocked(docs: DataFrame, key: str, text: str, split: tuple[int, int]) -> DataFrame:
    """Blocks of consecutive rows with their dictionaries and the words' counts in training texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, size = [], 0
        for batch in batches:
            for doc_id, out, value in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "text"))):
                held.append((doc_id, out, value))
                size += len(value)
                if size >= BLOCK_BYTES:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        for number, rows in enumerate(cut(batches)):
            coding = Coding()
            codes = [np.array(list(map(coding.__getitem__, t.lower().split())), dtype=np.uint32) for _, _, t in rows]
            trained = [c for c, (_, out, _) in zip(codes, rows) if not out] + [np.zeros(0, np.uint32)]
            seen = np.bincount(np.concatenate(trained), minlength=len(coding))
            lengths = [len(c) for c in codes]
            yield pa.RecordBatch.from_pydict({
                "block": [first + number], "doc_ids": [[r[0] for r in rows]], "held": [[r[1] for r in rows]],
                "lengths": [lengths], "codes": [press(np.concatenate(codes))],
                "words": [[w.decode("utf-8", "replace") for w in coding]], "seen": [seen.tolist()],
            }, schema=schema)

    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())), ("codes", pa.binary()), ("words", pa.list_(pa.string())),
        ("seen", pa.list_(pa.int64())),
    ])
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).cast("binary").alias("text")
    ).select("doc_id", held_out(F.col("doc_id"), *split).alias("held"), "text")
    return rows.mapInArrow(code, BLOCK_TYPE)


def encode(blocks: DataFrame, entries: DataFrame, facts: dict) -> DataFrame:
    """Blocks as symbols, with the sums that do not depend on the network."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left.to_pylist()[0]
        codes = unpress(block["codes"], "<u4")
        size = right.num_rows
        count, symbol = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.uint16)
        places = right.column("code").to_numpy()
        count[places], symbol[places] = right.column("c").to_numpy(), right.column("symbol").to_numpy()
        base = np.log10((count + 1) / facts["denominator"])
        rare_class = symbol.astype(np.int64) - WORDS
        inside = np.where(rare_class < 0, 0.0, np.log10((count + 1) / facts["rare"][np.maximum(rare_class, 0)]))
        lengths = np.array(block["lengths"], dtype=np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        total = lambda values: np.bincount(owner, weights=values[codes], minlength=len(lengths))
        symbols = np.full(len(codes) + len(lengths), WORDS + CLASSES, dtype="<u2")
        symbols[np.arange(len(codes)) + owner] = symbol[codes]
        return pa.Table.from_pydict({
            "doc_ids": [block["doc_ids"]], "held": [block["held"]], "lengths": [(lengths + 1).tolist()],
            "known": [(total(count > 0) + (facts["ends"] > 0)).astype(np.int32).tolist()],
            "base": [(total(base) + np.log10((facts["ends"] + 1) / facts["denominator"])).tolist()],
            "rare": [total(inside).tolist()], "symbols": [press(symbols)],
        }, schema=schema)

    schema = pa.schema([
        ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())),
        ("known", pa.list_(pa.int32())), ("base", pa.list_(pa.float64())), ("rare", pa.list_(pa.float64())),
        ("symbols", pa.binary()),
    ])
    # as many tasks as the blocks need, whatever the session's number of shuffle partitions
    tasks = -(-blocks.count() // BLOCKS_A_TASK) or 1
    left = blocks.select("block", "doc_ids", "held", "lengths", "codes").repartition(tasks, "block")
    return left.groupBy("block").cogroup(entries.groupBy("of_block")).applyInArrow(join, ENCODED_TYPE)


def texts_of(block: dict) -> tuple[np.ndarray, np.ndarray]:
    return unpress(block["symbols"], "<u2").astype(np.int32), np.array(block["lengths"], dtype=np.int64)


def chosen(symbols: np.ndarray, lengths: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return symbols[np.repeat(keep, lengths)], lengths[keep]


def train_round(encoded: DataFrame, net: Network, turn: int, rounds: int) -> Network:
    """The average of networks that start at `net` and learn a round's share of the training texts."""
    words, rare, start = net.words, net.rare, net.vector

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trainer, pending, held = Trainer(Network(words, rare, start.copy())), [], 0

        def flush() -> None:
            nonlocal pending, held
            if pending:
                trainer.learn(*(np.concatenate(part) for part in zip(*pending)))
            pending, held = [], 0

        for batch in batches:
            for block in batch.select(["held", "lengths", "symbols"]).to_pylist():
                symbols, lengths = texts_of(block)
                trained = np.flatnonzero(~np.array(block["held"], dtype=bool))
                keep = np.zeros(len(lengths), dtype=bool)
                # every training text belongs to one round
                keep[np.array_split(trained, rounds)[turn]] = True
                pending.append(chosen(symbols, lengths, keep))
                held += int(pending[-1][1].sum())
                if held >= TRAIN_TOKENS:
                    flush()
        flush()
        if trainer.tokens:
            part, vector = TaskContext.get().partitionId(), trainer.net.vector
            for chunk, at in enumerate(range(0, len(vector), CHUNK)):
                weighted = vector[at : at + CHUNK].astype(np.float64) * trainer.tokens
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int64()), "chunk": pa.array([chunk], pa.int32()),
                    "tokens": pa.array([trainer.tokens], pa.int64()), "sums": [weighted.tobytes()],
                })

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(s, dtype=np.float64) for s in rows.column("sums").to_pylist())
        return pa.table({
            "part": pa.array([key[0].as_py()], pa.int64()), "chunk": pa.array([key[1].as_py()], pa.int32()),
            "tokens": pa.array([sum(rows.column("tokens").to_pylist())], pa.int64()), "sums": [sums.tobytes()],
        })

    kind = "part long, chunk int, tokens long, sums binary"
    sums = stage_table(encoded.mapInArrow(learn, kind), "network-sums")
    while (last := sums.agg(F.max("part")).first()[0]) is not None and last > 0:
        merged = sums.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "chunk")
        sums = stage_table(merged.applyInArrow(add, kind), "network-sums")
    rows = sorted(sums.collect(), key=lambda r: r["chunk"])  # one network
    if not rows:
        return net
    return Network(words, rare, np.concatenate([np.frombuffer(r["sums"], dtype=np.float64) for r in rows]) / rows[0]["tokens"])


def scored(
    docs: DataFrame, key: str = "doc_id", text: str = "text", split: tuple[int, int] = HELD_OUT, rounds: int = ROUNDS
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    The scores are log10 probabilities of whole texts with their end.
    """
    blocks = stage_table(blocked(docs, key, text, split), "word-blocks")
    counts = stage_table(
        blocks.select(F.explode(F.arrays_zip("words", "seen")).alias("e")).groupBy(F.col("e.words").alias("word")).agg(
            F.sum("e.seen").alias("c")
        ),
        "word-counts",
    )
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    open_texts = F.size(F.filter("held", lambda out: ~out))
    ends = blocks.agg(F.coalesce(F.sum(open_texts), F.lit(0))).first()[0]
    train_tokens, distinct = sums[0] + ends, sums[1] + (ends > 0)
    top = counts.filter("c > 0").orderBy(F.desc("c"), "word").limit(WORDS).collect()
    frequent = {r["word"]: i for i, r in enumerate(top)}
    ending = F.right(F.col("word"), F.lit(2))
    spark = docs.sparkSession
    symbols = spark.createDataFrame([(w, i) for w, i in frequent.items()], "word string, own int")
    ranked = counts.join(symbols, "word", "left").withColumn("ending", ending)
    rare_words = ranked.filter(F.col("own").isNull() & (F.col("c") > 0))
    common = rare_words.groupBy("ending").agg(F.sum("c").alias("n")).orderBy(F.desc("n"), "ending").limit(CLASSES - 1)
    endings = spark.createDataFrame([(r["ending"], i) for i, r in enumerate(common.collect())], "ending string, class int")
    symbol = F.coalesce("own", F.col("class") + WORDS, F.lit(WORDS + CLASSES - 1)).cast("int")
    words = stage_table(ranked.join(endings, "ending", "left").select("word", "c", symbol.alias("symbol")), "word-symbols")
    shares = words.filter(F.col("symbol") >= WORDS).groupBy("symbol").agg(
        F.sum("c").alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("distinct")
    )
    rare_counts, rare = np.zeros(CLASSES), np.ones(CLASSES)
    for row in shares.collect():
        rare_counts[row["symbol"] - WORDS] = row["n"]
        rare[row["symbol"] - WORDS] = row["n"] + row["distinct"] + 1
    facts = {"denominator": train_tokens + distinct + 1, "ends": ends, "rare": rare}
    entries = blocks.select(F.col("block").alias("of_block"), F.posexplode("words").alias("code", "word")).join(words, "word")
    encoded = stage_table(encode(blocks, entries.select("of_block", "code", "c", "symbol"), facts), "encoded-blocks")
    own_counts = np.zeros(WORDS)
    own_counts[: len(top)] = [r["c"] for r in top]
    net = Network.initial(own_counts, rare_counts, ends)
    for turn in range(rounds):
        net = train_round(encoded, net, turn, rounds)
    return evaluated(encoded, net).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


def evaluated(encoded: DataFrame, net: Network) -> DataFrame:
    words, rare, vector = net.words, net.rare, net.vector

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(words, rare, vector)
        for batch in batches:
            pending, held = [], 0
            rows = batch.to_pylist()
            for i, block in enumerate(rows):
                pending.append(block)
                held += sum(block["lengths"])
                if held >= TRAIN_TOKENS or i == len(rows) - 1:
                    yield judge(model, pending)
                    pending, held = [], 0

    def judge(model: Network, some: list[dict]) -> pa.RecordBatch:
        symbols, lengths = (np.concatenate(part) for part in zip(*map(texts_of, some)))
        found = score(model, symbols, lengths) / np.log(10)
        flat = lambda name: [x for block in some for x in block[name]]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(flat("doc_ids"), pa.int64()), "held_out": pa.array(flat("held"), pa.bool_()),
            "n_tokens": pa.array(lengths), "n_known": pa.array(flat("known"), pa.int64()),
            "base_score": pa.array(flat("base"), pa.float64()),
            "score": pa.array(found + np.array(flat("rare"))),
        })

    return encoded.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
