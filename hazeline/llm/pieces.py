"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (a mark before it and for every blank) and cut into marked words. No piece of the
vocabulary holds a mark after another sign, or a line end, so the best path of a text is that of
its words. The distinct new words of a block are sorted, which is the depth-first order of their
trie: the forward scores of the prefix shared with the word before stay on the stack and only the
rest of the word is scored. The model file stores ranks, so a piece's score is the log-probability
of its rank under Zipf's law; signs outside the vocabulary cost ten more than the worst piece and
are written as byte pieces. Of equal paths the one with the
longer last piece wins. The model file is public and only read.

Null text is empty and encodes to nothing. Decoding gives the text back byte for byte, except that
a mark sign (U+2581) in a text is read as a blank, as the format has it. Rows are encoded one by
one, so repeated rows and ids do not matter. Memory of a task is bounded by `BLOCK_BYTES` of text
or the longest text, and by the cache of `CACHE_WORDS` words.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import text_slices, whole

MARK = "▁"
UNKNOWN_PENALTY = 10
BLOCK_BYTES = 1 << 23
CACHE_WORDS = 1_200_000
UNITS = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*").findall


class PieceCoder:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.id_of = {model.id_to_piece(i): i for i in normal}
        # stored scores are negative ranks; by Zipf's law rank r has a probability in proportion to 1 / (r + 2)
        share = {model.id_to_piece(i): 1 / (2 - model.get_score(i)) for i in normal}
        total = sum(share.values())
        self.scores = {piece: math.log(p / total) for piece, p in share.items()}
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        # every ending of a piece; None where the ending is no piece itself
        self.suffixes = {p[i:]: None for p in self.scores for i in range(len(p))} | self.scores
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.surface = [model.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        for byte, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([byte])
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.scores):
            raise ValueError("a piece crosses words or lines")
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """Keys of the marked words: a word's key lacks its first mark, and a key that starts with
        a line end stands for the line end and the unmarked word after it."""
        spaced = text.replace("\n", " \n")
        if "  " not in spaced and not text.startswith(" ") and MARK not in text:
            return spaced.split(" ")
        units = UNITS(MARK + text.replace(" ", MARK))
        return [u[1:] if u[0] == MARK else u for u in units]

    def segment(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """(key, ids as uint16 bytes) for distinct keys, depth-first through the words' trie."""
        suffixes, unknown, absent = self.suffixes, self.unknown, object()
        best, back, before = [0.0], [0], ""
        for word in sorted(w if w[:1] == "\n" else MARK + w for w in words):
            shared, limit = 0, min(len(word), len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, origin, start = None, end - 1, end - 1
                while start >= 0:
                    score = suffixes.get(word[start:end], absent)
                    if score is absent:  # no piece ends in this stretch
                        break
                    if score is not None:
                        score += best[start]
                        if top is None or score >= top:
                            top, origin = score, start
                    start -= 1
                if top is None or origin != end - 1 and suffixes.get(word[end - 1]) is None:
                    alone = best[end - 1] + unknown
                    if top is None or alone > top:
                        top, origin = alone, end - 1
                best.append(top)
                back.append(origin)
            before, ids, end = word, [], len(word)
            while end:
                start = back[end]
                piece = self.id_of.get(word[start:end])
                ids.append([piece] if piece is not None else [self.byte_ids[b] for b in word[start:end].encode()])
                end = start
            yield word if word[0] == "\n" else word[1:], np.array([i for part in reversed(ids) for i in part], dtype="<u2").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.words(t) if t else [] for t in texts]
        known = self.known
        missing = {w for words in split for w in words if w not in known}
        if len(known) + len(missing) > CACHE_WORDS:
            known.clear()
            missing = {w for words in split for w in words}
        known.update(self.segment(list(missing)))
        return [b"".join([known[w] for w in words]) for words in split]

    def decode(self, ids: list[int]) -> bytes:
        surface = self.surface
        return b"".join([surface[i] for i in ids])[1:]


_CODERS: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """One coder per Python worker."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, n_ids, round_trip) for every row; round_trip: decoding gave the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = coder(model)
        for batch in batches:
            for start, texts in text_slices(batch.column("text"), BLOCK_BYTES):
                stop, data = start + len(texts), codes.encode(texts)
                flat = np.frombuffer(b"".join(data), dtype="<u2")
                lengths = np.array([len(d) // 2 for d in data], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                same = [
                    codes.decode(np.frombuffer(d, dtype="<u2").tolist()) == t.replace(MARK, " ").encode()
                    for d, t in zip(data, texts)
                ]
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), ids, pa.array(lengths), pa.array(same)],
                    names=["doc_id", "ids", "n_ids", "round_trip"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, round_trip boolean")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 are replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = coder(model)
        for batch in batches:
            texts = [codes.decode(x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
