"""Token alignment and phrase mining against plain Python."""

import collections
import hashlib
import random
import re

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hazeline.llm import alignment, collocations
from hazeline.llm.queries import BYTE_TOKENIZER, PIECE_MODEL
from tests.llm.test_operators import ROWS, SCHEMA, lower

PATHS = (public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL))
NO_TOKENS = ((), ())


def byte_table():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    return signs | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


@pytest.fixture(scope="module")
def both():
    a, b, signs = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), byte_table()
    a.encode_special_tokens = True

    def tokens(text):
        """[(id, bytes)] of both sides."""
        if not text:
            return NO_TOKENS
        left = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            right.append((i, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (left, right) if all(b"".join(x for _, x in side) == raw for side in (left, right)) else NO_TOKENS

    return tokens


def spans(tokens):
    at, found = 0, []
    for i, data in tokens:
        found.append((i, at, at + len(data)))
        at += len(data)
    return found


def brute_force(tokens, rows):
    linked, docs = [], collections.Counter()
    for _, text in rows:
        left, right = map(spans, tokens(text))
        pairs = [(a, b) for a, s, e in left for b, t, f in right if s < f and t < e]
        linked.append((left, right, pairs))
        docs.update(set(pairs))
    best = collections.Counter()
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), (left, right, pairs) in zip(rows, linked):
        ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups = [
            ",".join(str(i) for i, _, e in left if s < e <= t) + "|" + ",".join(str(i) for i, _, e in right if s < e <= t)
            for s, t in zip([0, *ends], ends)
        ]
        text = ";".join(groups)
        out.append((
            doc_id, len(left), len(right), len(groups), len(pairs), sum(docs[p] == best[p[0]] for p in pairs),
            sum(docs[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if groups else "", text,
        ))
    return out


# a text that holds the mark of a blank is not given back by the second side
TEXTS = [
    "▁ mark", "naïve café, déjà vu: ½ ①", "tab\tand\n\nlines  ", "日本語のテキスト 🙂🙂", "<|endoftext|> and </s> <s> <unk> <0x41>",
    "x\0y", " leading", "a", " ", "É" * 40, "thhe inn erst, thorat andeainea", "thhe inn erst, thorat andeainea",
]


@pytest.mark.parametrize("size", [1 << 24, 200])
def test_alignment(spark, both, size, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", size)
    rows = [(r[0], r[1] if r[1] is None or len(r[1]) < 3000 else r[1][:1500]) for r in ROWS]
    rows += [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, TEXTS[1]) for i in range(40)]
    docs = spark.createDataFrame([(*r, *[None] * 6) for r in rows], SCHEMA).repartition(3)
    want = brute_force(both, rows)
    measures, pairs = alignment.aligned(docs, *PATHS)
    got = [tuple(r) for r in measures.collect()]
    assert sorted(got, key=repr) == sorted((w[:-1] for w in want), key=repr)
    spelled = sorted(((r["doc_id"], r["groups"]) for r in alignment.groups(docs, *PATHS).collect()), key=repr)
    assert spelled == sorted(((w[0], w[-1]) for w in want), key=repr)
    assert any(w[1] for w in want) and any(not w[1] for w in want)
    docs_of = collections.Counter()
    for _, text in rows:
        left, right = map(spans, both(text))
        docs_of.update({(a, b) for a, s, e in left for b, t, f in right if s < f and t < e})
    assert {(r["a"], r["b"]): r["n_docs"] for r in pairs.collect()} == docs_of


def test_alignment_of_nothing(spark):
    measures, pairs = alignment.aligned(spark.createDataFrame([], SCHEMA), *PATHS)
    assert measures.count() == 0 and pairs.count() == 0
    blank = spark.createDataFrame([(1, None, *[None] * 6), (2, "", *[None] * 6)], SCHEMA)
    assert sorted(tuple(r) for r in alignment.aligned(blank, *PATHS)[0].collect()) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")
    ]


def brute_phrases(rows, min_count, max_words, top, percent):
    counts, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(max_words, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    dropped = set()
    for (lang, longer), f in candidates.items():
        for m in range(2, len(longer)):
            for i in range(len(longer) - m + 1):
                inner = (lang, longer[i : i + m])
                if 100 * f >= percent * candidates[inner]:
                    dropped.add(inner)
    rows = []
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) not in dropped:
            cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, l, r = min((1000 * a * n[lang] // (l * r), k, l, r) for l, r, k in cuts)
            rows.append((lang, -score, -a, b" ".join(phrase), l, r))
    out, rank = [], collections.Counter()
    for lang, score, a, phrase, l, r in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


@pytest.mark.parametrize("block", [1 << 25, 300])
def test_collocations(spark, block, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "SHARES", 3)
    dice = random.Random(5)
    words = ["the", "of", "New", "York", "city", "É", "É\xa0x", "naïve", "a\x1cb", "<s>", "one", "two", "three", "four", "five"]
    fixed = "New York city", "one two three four five", "one two three four six", "the of"
    rows = []
    for i in range(400):
        parts = [dice.choice(words) if dice.random() < 0.5 else dice.choice(fixed) for _ in range(dice.randrange(12))]
        text = "".join(p + dice.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "!?", "\r\n", "\x0b"]) for p in parts)
        rows.append((text, dice.choice(["en", "en", "en", "fr", None, "und"])))
    rows += [(None, "en"), ("", None), ("new york city " * 400, "de"), *[("the very same text of all copies", "en")] * 30]
    docs = spark.createDataFrame([(i % 50, t, g, *[None] * 5) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(5)
    for options in ((9, 5, 2000, 100), (3, 4, 7, 80), (20, 2, 3, 100)):
        want = brute_phrases(rows, *options)
        got = [tuple(r) for r in collocations.collocations(docs, *options).collect()]
        assert sorted(got) == sorted(want) and want


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    few = spark.createDataFrame([(1, "so few words.", "en", *[None] * 5)], SCHEMA)
    assert collocations.collocations(few).count() == 0


def test_scores_beyond_64_bits(spark):
    n = 9 * 10**16
    row = spark.createDataFrame([(n, n, 10**9, 10**9)], "a long, n long, l long, r long")
    product = (collocations.exact("a") * collocations.exact("n")).cast("decimal(35,0)")
    assert product is not None
    value = row.select(product.alias("p")).first()[0]
    assert int(value) == n * n
