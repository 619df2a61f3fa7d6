"""Encoders against the tokenizers library, and packing against plain Python."""

import itertools
import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hazeline.llm import bpe, packing
from hazeline.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER
from tests.llm.test_operators import ROWS, SCHEMA

FILES = [BYTE_TOKENIZER, WORD_TOKENIZER]
ODD = [
    "It's we're,. don't!!!", "ÉCOLE ﬁ İstanbul ΣΑΣ", "1234 ... <|endoftext|> a.", "x\x1cq\x85r\0z", "H̱ é. ½. ①!",
    "日本語。 テスト…… ..a", "'s 't 're. x's. y'LL!", "▁ a\xadb", "", " ", "\n\n  \t", "é", "🙂🙂 ok", " " * 120_000 + "x",
    "a" * 50_000, "\0", "<|startoftext|>",
]


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("special", [True, False])
def test_encoder_equals_the_library_on_odd_texts(name, special):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = not special
    coder = bpe.Encoder(public_tokenizers.path(name), special)
    assert coder.encode(ODD) == [library.encode(t, add_special_tokens=False).ids for t in ODD]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_the_library_on_every_code_point(name):
    path = public_tokenizers.path(name)
    library, coder = Tokenizer.from_file(path), bpe.encoder(path)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 20_000):
        texts = [f"a{c}B 1{c}2 .{c}, {c}{c}  {c} X{c}  y" for c in points[start : start + 20_000]]
        assert coder.encode(texts) == [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_encoder_equals_the_library_on_random_texts(name, text):
    path = public_tokenizers.path(name)
    coder = bpe.encoder(path)
    assert coder.encode([text]) == [coder.library.encode(text, add_special_tokens=False).ids]


def best_sum(available, room):
    sums = {0}
    for length, left in available:
        sums = {s + length * k for s in sums for k in range(left + 1) if s + length * k <= room}
    return max(sums)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=8), st.integers(0, 40))
def test_fullest_combination(counts, room):
    available = sorted(counts.items(), reverse=True)
    used = packing.fullest(available, room)
    assert all(0 < k <= counts[n] for n, k in used.items())
    assert sum(n * k for n, k in used.items()) == best_sum(available, room)


def one_bin_at_a_time(counts, size):
    """Fill of each bin: the longest piece left and the best sum of the others, by brute force."""
    left, fills = dict(counts), []
    for used in itertools.chain.from_iterable([u] * n for n, u in packing.plan(counts, size)):
        longest = max(n for n, c in left.items() if c)
        assert used.get(longest)
        others = [(n, c - (n == longest)) for n, c in left.items() if c - (n == longest) > 0]
        fill = sum(n * k for n, k in used.items())
        assert fill == longest + best_sum(others, size - longest)
        for n, k in used.items():
            left[n] -= k
            assert left[n] >= 0
        fills.append(fill)
    assert not any(left.values())
    return fills


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 9), max_size=6))
def test_every_bin_has_minimum_slack(counts):
    fills = one_bin_at_a_time(counts, 16)
    assert sum(fills) == sum(n * c for n, c in counts.items())


def check_packing(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    path = public_tokenizers.path(BYTE_TOKENIZER)
    placements, pieces = packing.packed(docs, path)
    library, want = Tokenizer.from_file(path), {}
    for doc_id, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        want.setdefault(doc_id, []).append(ids)
    found = [r.asDict() for r in placements.collect()]
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append(r)
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.SEQUENCE
    for doc_id, texts in want.items():
        got = sorted((r["start"], r["piece"], r["length"], r["ids_crc32"]) for r in found if r["doc_id"] == doc_id)
        cut = []
        for ids in texts:
            rest = len(ids) % packing.SEQUENCE or packing.SEQUENCE
            edges = [0, *range(min(rest, len(ids)), len(ids) + 1, packing.SEQUENCE)]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                cut.append((a, i, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        assert got == sorted(cut)
    total = sum(r["length"] for r in found)
    whole = {r["sequence_id"]: r for r in packing.sequences(placements, pieces).collect()}
    assert sum(r["n_tokens"] for r in whole.values()) == total and set(whole) == set(bins)
    for i, members in bins.items():
        assert whole[i]["doc_ids"] == [r["doc_id"] for r in sorted(members, key=lambda r: r["offset"])]
        for r in members:
            ids = whole[i]["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
            assert zlib.crc32(bytes(ids)) == r["ids_crc32"]
    return len(bins), total


def test_packing(spark):
    bins, total = check_packing(spark, ROWS)
    assert bins <= -(-total // packing.SEQUENCE) + 1


def test_packing_of_one_hot_length(spark):
    rows = [(i, "one two three " * (1 if i % 3 else 150), *[None] * 6) for i in range(900)]
    bins, _ = check_packing(spark, rows)
    assert bins == 150  # two of the 300 long texts fit into a sequence, with room for all short ones


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    placements, pieces = packing.packed(docs, public_tokenizers.path(BYTE_TOKENIZER))
    assert placements.count() == 0 and packing.sequences(placements, pieces).count() == 0
