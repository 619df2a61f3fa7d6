"""Every operator against brute force on rows with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from hazeline.llm import (
    exact, language, language_model, license_rules, licenses, mixing, pieces, quality_rules, rule_ensemble, simhash, wavelet,
)
from hazeline.llm.queries import PIECE_MODEL, WORD_TOKENIZER

# the last columns clash with names that the operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rec string, _own_key string"
WORDS = [f"{a}{b}" for a in ("ta", "mo", "ri", "sel", "ku") for b in ("ne", "lo", "vi", "rask", "du", "em")]


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(np.array(WORDS)[rng.integers(0, len(WORDS), n)])


LONG = sentence(1, 30_000)
TEXTS = [
    None, "", "  \t ", "one", "Two Words", "two words", "É É é", "a\x0bb\x1cc\xa0d",
    sentence(2, 60), sentence(2, 60).upper(), sentence(2, 60) + " end", sentence(3, 120), sentence(3, 120),
    "x y z w v u t s " * 12, sentence(4, 50) + "\nshared line of many texts here\n" + sentence(5, 50), LONG, LONG,
    "Released under the MIT License. Or the Apache License, Version 2.0!", "SPDX-License-Identifier: GPL-3.0-or-later",
    "mit license mit license general public license", "### $$$ ||| <b>", "tab\tand\r\nline  double\n\n\nend ",
]
ROWS = [(i, t, "en", f"src{i % 3}" if i % 5 else None, 0, 7, "r", "k") for i, t in enumerate(TEXTS)]
ROWS += [ROWS[8], ROWS[8], (None, "no id", None, None, None, None, None, None), (None, None, None, "src1", 1, 1, "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").encode().lower()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def table_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_wavelet_answers_match_the_sequence():
    tokens = (np.random.default_rng(1).zipf(1.4, 5000) % 700).astype(np.uint16)
    matrix = wavelet.open_shard(wavelet.pack_shard([1], np.array([5000]), tokens, 0))[0]
    assert (matrix.tokens() == tokens).all()
    assert [matrix.access(i) for i in range(0, 5000, 97)] == tokens[::97].tolist()
    for token in (1, 2, 9, 699, 60000):
        places = np.flatnonzero(tokens == token)
        assert matrix.count(token) == len(places)
        assert matrix.count(token, 100, 3000) == ((places >= 100) & (places < 3000)).sum()
        assert [matrix.locate(token, k) for k in range(len(places))] == places.tolist()
        with pytest.raises(IndexError):
            matrix.locate(token, len(places))


def test_token_shards_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_TOKENIZER)
    whole = Tokenizer.from_file(path)
    want, start = [], 0
    for doc_id, text in sorted(((r[0], r[1] or "") for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [wavelet.END_ID], dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert table_of(wavelet.encoded_documents(docs, path)) == sorted(want, key=repr)
    assert wavelet.encoded_documents(none, path).count() == 0


def test_token_occurrences(spark, docs):
    from hazeline.session import work_dir

    path, folder = public_tokenizers.path(WORD_TOKENIZER), work_dir(spark, "shards")
    wavelet.write_shards(docs.filter("doc_id = 19"), folder, path)
    found = wavelet.occurrences(spark, folder, wavelet.END_ID).collect()
    tokens = wavelet.read_documents(spark, folder).first()["n_tokens"]
    assert [tuple(r) for r in found] == [(19, tokens - 1)]


def test_language_model_scores(docs, none):
    rows = language_model.scored(docs).collect()
    held = {r[0]: zlib.crc32(("null" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in ROWS}
    counts = collections.Counter()
    for row in ROWS:
        if not held[row[0]]:
            counts.update(lower(row[1]).split() + [None])
    total, distinct, want = sum(counts.values()), len(counts), []
    for row in ROWS:
        tokens = lower(row[1]).split() + [None]
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        want.append((row[0], held[row[0]], len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 5)))
    assert sorted([(*r[:5], round(r[5], 5)) for r in rows], key=repr) == sorted(want, key=repr)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert language_model.scored(none).count() == 0


def test_language_model_beats_the_base_on_held_out_texts(spark):
    # every text uses one of two vocabularies, which the base cannot know
    other = str.maketrans("aeiou", "öäüïë")
    rows = [(i, t if i % 2 else t.translate(other)) for i in range(160) for t in [sentence(i, 250)]]
    got = language_model.scored(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert len(got) > 10 and all(r["score"] > r["base_score"] for r in got)


def test_network_gradients_and_carried_state():
    from hazeline.llm.recurrent import GROUP, HIDDEN, Network, score

    rng = np.random.default_rng(0)
    net = Network.initial(rng.integers(1, 50, 2 * GROUP).astype(float), rng.integers(1, 9, 3).astype(float), 5)
    symbols, lengths = rng.integers(0, net.end, 300), np.array([300])
    symbols[-1] = net.end
    inputs = np.concatenate([[net.end], symbols[:-1]])
    whole, _, _ = net.run(inputs[:, None], np.arange(300)[:, None] == 0, np.zeros((1, HIDDEN), np.float32))
    found, _ = net.output(whole.reshape(-1, HIDDEN), symbols, None)
    assert score(net, symbols, lengths)[0] == pytest.approx(found.sum(), rel=1e-5)

    fresh = np.arange(12)[:, None] % 5 == 0

    def loss():
        out, _, kept = net.run(inputs[:12, None], fresh, np.zeros((1, HIDDEN), np.float32))
        return -net.output(out.reshape(-1, HIDDEN), symbols[:12], None)[0].sum(), out, kept

    grads = Network(net.words, net.rare)
    _, out, kept = loss()
    _, back = net.output(out.reshape(-1, HIDDEN), symbols[:12], grads.p)
    net.backward(inputs[:12, None], fresh, back.reshape(12, 1, HIDDEN), kept, grads.p)
    for name in net.p:
        flat, slope = net.p[name].reshape(-1), grads.p[name].reshape(-1)
        for i in np.argsort(-np.abs(slope))[:3]:
            kept_value = flat[i]
            flat[i] = kept_value + 1e-2
            up = loss()[0]
            flat[i] = kept_value - 1e-2
            down = loss()[0]
            flat[i] = kept_value
            assert (up - down) / 2e-2 == pytest.approx(slope[i], rel=0.05, abs=2e-3), name


def test_exact_dedup(spark, docs, none):
    groups = collections.defaultdict(list)
    for row in ROWS:
        groups[lower(row[1])].append(row[0])
    got = exact.deduplicated(docs).collect()
    assert len(got) == len(ROWS)
    for row in got:
        ids = next(g for t, g in groups.items() if __import__("hashlib").sha256(t).hexdigest() == row["text_sha256"])
        known = [i for i in ids if i is not None]
        assert (row["keep_id"], row["group_size"]) == (max(known) if known else None, len(ids))
    assert sum(r["kept"] for r in got) == len(groups)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact.deduplicated(none).count() == 0 and exact.drop_copies(none).count() == 0


def test_digest_index_is_persistent(spark, docs):
    from hazeline.session import work_dir

    path, rows = work_dir(spark, "index"), exact.digests(docs)
    for _ in range(2):
        exact.add_delivery(spark, path, rows)
    first = table_of(spark.table(exact.open_index(spark, path)))
    assert len(first) == rows.select("digest").distinct().count()
    exact.add_delivery(spark, path, exact.digests(docs.limit(0).unionByName(docs).withColumn("doc_id", F.lit(10**6))))
    assert table_of(spark.table(exact.open_index(spark, path))) == first
    plan = spark.table(exact.open_index(spark, path)).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the buckets replace the shuffle
    exact.compact_index(spark, path, f"{path}-new", rows=40 * exact.BUCKET_ROWS)
    again = spark.table(exact.open_index(spark, f"{path}-new"))
    assert table_of(again) == first and exact.index_buckets(spark, f"{path}-new") == 40
    assert exact.index_buckets(spark, path) == exact.LEAST_BUCKETS and len(again.inputFiles()) <= 40


def test_later_delivery_is_filtered_by_the_index(spark, tmp_path):
    schema, path = "doc_id long, text string", str(tmp_path / "deliveries")
    first = spark.createDataFrame([(1, "one text"), (2, "One Text"), (3, "second")], schema)
    later = spark.createDataFrame([(2, "one text"), (3, "SECOND"), (4, "third"), (None, "third"), (9, None)], schema)
    with pytest.raises(ValueError):
        exact.drop_copies(first, path=path)
    for _ in range(2):  # a delivery that is run again keeps the same rows
        assert table_of(exact.drop_copies(first, path=path, delivery="a")) == [(2, "One Text"), (3, "second")]
        assert table_of(exact.drop_copies(later, path=path, delivery="b")) == [(4, "third"), (9, None)]
    assert exact.drop_copies(later).count() == 4  # a new index knows no earlier delivery


def pages_and_documents(spark):
    texts = {"en": "the cat and the dog with this thing ", "fr": "le chat et le chien avec cette chose "}
    rows = [(i, texts[lang] * 5, lang) for i, lang in enumerate(["en", "fr"] * 4)] + [(9, None, "en"), (10, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    page = lambda lang, text: f'<html lang="{lang}"><script>the the</script><p>{text}</p></html>'
    pages = [(i, "http://un.example.fr/a", page("fr", texts["fr"])) for i in range(6)]
    pages += [(10, "https://u@un.example.fr:80/x", page("en", "le")), (11, None, None), (12, "nonsense", page("en", "the dog")),
              (13, "http://one.example.com", page("fr", texts["en"] * 3)), (13, "http://one.example.com", None), (None, "", "")]
    return spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit(1)), docs


def test_language_evidence(spark):
    pages, docs = pages_and_documents(spark)
    names, table = language.profiles(docs)
    counts = np.stack([sum(language.trigrams(r["text"] or "") for r in docs.filter(F.col("lang") == n).collect()) for n in names])
    want = np.log((counts + language.SMOOTH) / (counts.sum(axis=1, keepdims=True) + language.SMOOTH * language.BINS))
    assert names == ["en", "fr"] and np.allclose(table, want)
    got = language.identified(pages, docs).collect()
    assert len(got) == pages.count() and all(0 < r["probability"] <= 1 for r in got)
    by_page = {r["page_id"]: r["lang"] for r in got if r["page_id"] not in (None, 13)}
    assert all(by_page[i] == "fr" for i in range(6)) and by_page[12] == "en"
    assert by_page[10] == "fr"  # text and host outweigh the wrong declaration
    assert language.identified(pages.limit(0), docs).count() == 0
    assert {r["lang"] for r in language.identified(pages, docs.limit(0)).collect()} == {None}


def base_rules(text):
    text = text or ""
    words, lines = words_of(text), [x for x in text.split("\n") if words_of(x)]
    grams = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(text.count(s) for s in quality_rules.SYMBOLS)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(docs, none):
    got = quality_rules.judged(docs).collect()
    assert sorted([(r[0], *r[1:7]) for r in got], key=repr) == sorted([(r[0], *base_rules(r[1])) for r in ROWS], key=repr)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality_rules.judged(none).count() == 0 and quality_rules.keep_good(none).count() == 0


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain_lines(text):
    """{normalised line: words} of the lines with a word."""
    return {" ".join(words_of(x)).lower(): len(words_of(x)) for x in text.split("\n") if words_of(x)}


def brute_lines(rows, max_texts=20, max_share=0.005, min_left=0.2):
    """(owner of each frequent line, kept (host, text) pairs) for rows of (doc_id, text, host)."""
    pages = {(host, text or "") for _, text, host in rows}
    on, texts = collections.defaultdict(list), collections.Counter(h for h, t in pages if plain_lines(t))
    for host, text in pages:
        for line in plain_lines(text):
            on[host, line].append(text)
    frequent = {k for k, v in on.items() if len(v) > max_texts and len(v) > max_share * texts[k[0]]}
    good = {p for p in pages if not base_rules(p[1])[-1]}

    def left(host, text, stays=lambda line: False):
        lines = plain_lines(text)
        return 1 - sum(n for x, n in lines.items() if (host, x) in frequent and not stays(x)) / sum(lines.values())

    owner = {}
    for host, line in frequent:
        able = [t for t in on[host, line] if (host, t) in good]
        sturdy = [t for t in able if left(host, t) >= min_left]
        owner[host, line] = min(map(md5, sturdy or able), default=None)
    owns = lambda host, text: lambda line: owner.get((host, line)) == md5(text)
    kept = {
        (h, t) for h, t in good
        if any(map(owns(h, t), plain_lines(t))) or left(h, t, owns(h, t)) >= min_left
    }
    return owner, kept


def test_frequent_lines_deplete(spark):
    lines = [f"{sentence(100 + k, 12)}" for k in range(3)]
    rows = [(i, "\n".join(lines[:2] if i % 2 else lines), "a") for i in range(2)]
    rows += [(10 + i, "\n".join([*lines, sentence(200 + i, 8)]), "a") for i in range(8)]
    rows += [(30 + i, "\n".join([lines[0], sentence(300 + i, 40)]), None) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = {"max_texts": 3, "max_share": 0.5, "min_left": 0.3}
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs, **limits).collect()}
    _, kept = brute_lines(rows, **limits)
    assert got == {i: (h, t) in kept for i, t, h in rows} and 0 < sum(got.values()) < len(got)


@pytest.mark.parametrize("bodies", [40, 3])
def test_a_passage_never_goes_with_its_owner(spark, bodies):
    """The smallest digests fail the base rules or, with short bodies, every text would be depleted."""
    passage = sentence(900, 30)
    rows = [(i, f"{passage}\n{sentence(901 + i, bodies)}", "a") for i in range(60)]
    rows.sort(key=lambda r: md5(r[1]))
    rows[:30] = [(i, "\n".join([passage] + [x for x in ["again and again"] for _ in range(40)] + [str(i)]), "a") for i, *_ in rows[:30]]
    assert all(base_rules(t)[-1] for _, t, _ in rows[:30])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = [r["text"] for r in quality_rules.clean_good(docs).collect()]
    assert sum(passage in t for t in left) == 1 and len(left) == (30 if bodies == 40 else 1)


def test_frequent_lines_are_cut_from_kept_texts(spark, none):
    head, foot = "Site  HEADER of this host", "foot line of\tthis host"
    bodies = [sentence(400 + i, 40) for i in range(30)]
    rows = [(i, "\n".join([head if i % 2 else head.lower(), "", body, head, foot]), "a") for i, body in enumerate(bodies)]
    rows += [(100, rows[3][1], "a"), (101, rows[3][1], "b"), (102, sentence(500, 30) + "\r\n \n", "a"), (103, None, "a")]
    rows += [(104 + i, f"{head}\n{foot}\n{sentence(600 + i, 16)}", None) for i in range(25)]  # copies without a host
    rows += [(200 + i, "\n".join([sentence(700, 200), foot, sentence(701 + i, 5)]), "c") for i in range(25)]  # depleted
    rows += [(300, "\n".join(sentence(k, 2) for k in range(800, 1100)), "d")]
    rows += [(301 + i, f"{rows[-1][1]}\n{sentence(1200 + i, 900)}", "d") for i in range(25)]  # many frequent lines
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    plain = lambda line: " ".join(words_of(line)).lower()
    owner, wanted = brute_lines(rows)
    cut = lambda host, t: "\n".join(x for x in t.split("\n") if owner.get((host, plain(x)), md5(t)) == md5(t))
    kept = {r["doc_id"] for r in quality_rules.keep_good(docs).collect()}
    assert kept == {i for i, t, h in rows if (h, t or "") in wanted}
    got = quality_rules.clean_good(docs)
    assert got.columns == docs.columns
    assert table_of(got) == sorted([(i, cut(h, t), h) for i, t, h in rows if i in kept], key=repr)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert sum(t != s for i, s, _ in rows if (t := texts.get(i)) is not None) > 60 and len(kept) < len(rows) - 20
    assert table_of(corpus_pipeline.quality(spark, docs, "")) == table_of(got)
    assert quality_rules.clean_good(none).count() == 0


def test_piece_coding(docs, none):
    model = public_tokenizers.path(PIECE_MODEL)
    coder = pieces.PieceCoder(model)

    def best_path(word):
        best, back = [0.0] + [None] * len(word), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for start in range(end):
                score = coder.scores.get(word[start:end], coder.unknown if start == end - 1 else None)
                if score is not None and (best[end] is None or best[start] + score > best[end]):
                    best[end], back[end] = best[start] + score, start
        found, end = [], len(word)
        while end:
            piece = word[back[end] : end]
            found.append([coder.id_of[piece]] if piece in coder.id_of else [coder.byte_ids[b] for b in piece.encode()])
            end = back[end]
        return [i for part in reversed(found) for i in part]

    sample = ["the", "thing", "Straße", "日本x", "aaaaaaaaab", "éé", "running-fast", "🎉"]
    for word, data in zip(sample, coder.encode(sample)):
        assert np.frombuffer(data, "<u2").tolist() == best_path(pieces.MARK + word)
    got = pieces.encoded(docs, model)
    assert got.count() == len(ROWS) and got.filter("round_trip").count() == len(ROWS)
    back = table_of(pieces.decoded(got, model))
    assert back == sorted([(r[0], r[1] or "") for r in ROWS], key=repr)
    assert pieces.encoded(none, model).count() == 0
    assert len(coder.encode(["x" * 100_000])[0]) > 0


def test_license_scan(docs, none):
    letters = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    want = []
    for row in ROWS:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (row[1] or "").translate(letters))
        places = [
            (i, label) for phrase, label in license_rules.BASE_PHRASES for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts, labels = [p[0] for p in places], ",".join(sorted({p[1] for p in places}))
        want.append((row[0], len(words), len(starts), min(starts, default=None), max(starts, default=None), labels))
    got = licenses.scan(docs).collect()
    assert sorted([r[:6] for r in got], key=repr) == sorted(want, key=repr)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[18] == "gpl-3.0-or-later"  # the shorter name lies inside and is suppressed
    assert labels[17] == "apache,apache-2.0,mit"
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert licenses.scan(none).count() == 0
    assert len(license_rules.rules()) > 300


def test_license_phrases_pass_the_gate(spark):
    texts = {
        "This program is distributed under the GNU GPL version 2": "gpl-2.0", "released under the Apache 2.0": "apache-2.0",
        "It is available under CC BY 4.0.": "cc-by", "Distributed under the terms of the zlib": "zlib", "under the sea": "",
    }
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["labels"] for r in sorted(got)] == list(texts.values())
    assert [r["score"] for r in sorted(got)] == [0.9, 0.9, 0.9, 0.9, 0.0]
    for rule in license_rules.rules():
        assert all(any(gate in word for gate in license_rules.gates()) for word in rule["keys2"])


def alternatives(parsed):
    """Every text of a parsed rule, with the least and one more of each repeat; look-arounds are left out."""
    texts = [""]
    for kind, value in parsed:
        if kind is re._constants.LITERAL:
            found = [chr(value)]
        elif kind is re._constants.BRANCH:
            found = [t for part in value[1] for t in alternatives(part)]
        elif kind is re._constants.SUBPATTERN:
            found = alternatives(value[3])
        elif kind is re._constants.MAX_REPEAT:
            low, high, part = value
            found = [t * n for n in range(low, min(high, low + 1) + 1) for t in alternatives(part)]
        elif kind is re._constants.IN:
            (what, entry), *rest = value
            if what is re._constants.CATEGORY:
                found = ["x" if entry is re._constants.CATEGORY_NOT_SPACE else "7"]
            else:
                found = [chr(c) for w, e in value for c in (range(e[0], e[1] + 1) if w is re._constants.RANGE else [e])]
        else:
            assert kind in (re._constants.ASSERT, re._constants.ASSERT_NOT), kind
            found = [""]
        texts = [t + f for t in texts for f in dict.fromkeys(found)]
    return texts


def test_license_rules_pass_their_own_prefilter(spark):
    cases, without = [], []
    for rule in license_rules.rules():
        regex = re.compile(f"(?<= )(?:{rule['regex']})(?= )")
        found = []
        for text in alternatives(re._parser.parse(rule["regex"])):
            # the fifth phrase looks ahead for the word that makes its name a licence
            found += [t for t in (f" {text} ", f" {text} license ") if regex.search(t)][:1]
        for text in found:
            assert any(k in text for k in rule["keys"]) and any(k in text for k in rule["keys2"]), (rule["rule"], text)
            assert any(gate in text for gate in license_rules.gates())
        cases += [(rule["rule"], text) for text in sorted(found, key=len)[:1]]
        without += [] if found else [rule]
    # only names that end in a digit can follow the fifth phrase
    assert all(r["regex"].endswith(r"(?<=\d)") for r in without)
    assert len(cases) + len(without) == len(license_rules.rules())
    rows = licenses.scanned(spark.createDataFrame(cases, "doc_id long, text string"))
    hits = licenses.detections(rows).join(rows, "row_id").select("doc_id", "rule").distinct().collect()
    assert {rule for rule, _ in cases} == {r["doc_id"] for r in hits if r["doc_id"] == r["rule"]}


def test_license_identifiers_and_short_names(spark):
    texts = {
        "SPDX-License-Identifier: BSL-1.0": "boost-1.0", "SPDX-License-Identifier: OFL-1.1": "ofl-1.1",
        "Expat License": "mit", "licensed under the GFDL": "gfdl", "https://opensource.org/license/mit": "mit",
    }
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["labels"] for r in sorted(got)] == list(texts.values())


def test_mixing(spark, docs, none):
    rows = mixing.mixed(docs, ["doc_id"]).select("rec.doc_id", "size", "source", "source_size", "target", "copies").collect()
    sizes = collections.Counter()
    for row in ROWS:
        sizes[row[3]] += len(words_of(row[1]))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, total = {}, 1.5 * sum(sizes.values())
    while True:  # the excess of capped sources is shared again
        left = [s for s in order if s not in target]
        rest = total - sum(target.values())
        over = [s for s in left if rest * weight[s] / sum(weight[x] for x in left) > 2 * sizes[s]]
        if not over:
            target.update({s: rest * weight[s] / sum(weight[x] for x in left) for s in left})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
    assert len(rows) == len(ROWS)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]] and row["target"] == pytest.approx(target[row["source"]])
        assert 0 <= row["copies"] <= 2
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed(none, ["doc_id"]).count() == 0 and mixing.mix(none).count() == 0


def test_mixing_spreads_rows_without_an_id(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("w "), "id").alias("text"), F.lit("s").alias("source"))
    plan = mixing.mixed(rows, ["text"])
    assert plan.count() == 3000
    buckets = rows.select(F.substring(F.md5(F.concat_ws("|", F.lit("null"), F.md5(F.col("text").cast("binary"))).cast("binary")), 1, 2))
    assert buckets.distinct().count() > 200


def test_mixing_comes_near_the_targets(spark):
    rows = [(i, sentence(i, 20 + i * 7 % 90), f"s{i % 4}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.mixed(docs, ["doc_id"]).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")
    )
    assert all(abs(r["taken"] / r["target"] - 1) < 0.02 for r in taken.collect())


def test_rule_ensemble(spark, none):
    good = [(i, sentence(i, 80) + ".", int(i % 9 > 0)) for i in range(120)]
    bad = [(200 + i, " ".join(w + "###" for w in sentence(i, 60).split()), 0) for i in range(120)]
    rows = [(i, t, 1) for i, t, _ in good] + bad
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (999, "")], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, q) for i, _, q in rows] + [(0, None), (None, 1)], "doc_id long, quality int"
    )
    got = rule_ensemble.classified(docs, labels).collect()
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == docs.count() and held and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["score"] for r in rule_ensemble.classified(docs, labels.limit(0)).collect()} == {0.5}
    assert rule_ensemble.classified(none, labels).count() == 0


def slow_fingerprint(text):
    words = lower(text).split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = {}
    for _, text in rows:
        prints[text] = slow_fingerprint(text)
    nodes = sorted(set(prints.values()))
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for doc_id, text in rows:
        root = find(prints[text])
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(doc_id, prints[text], least.get(find(prints[text]))) for doc_id, text in rows]


@pytest.mark.parametrize("limit", [simhash.GROUP_LIMIT, 1])
def test_simhash_components(spark, docs, none, limit, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.RADIUS, limit))
    extra = [(1000 + i, LONG.replace(" ", "  ") + " " + w) for i, w in enumerate(WORDS[:12])]
    rows = [(r[0], r[1]) for r in ROWS if r[1] != LONG or r[0] == 15] + extra[:6]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_groups(table).collect()]
    assert sorted(got, key=repr) == sorted(brute_components(rows), key=repr)
    assert simhash.near_groups(none).count() == 0


def test_near_copies_without_or_with_repeated_ids(spark, none):
    base, other, third, fourth = (sentence(i, 400) for i in (61, 62, 63, 64))
    rows = [
        (None, base), (None, other), (None, other.upper()), (None, None),  # no ids: one of each group stays
        (5, third), (7, third.upper()), (7, fourth), (7, fourth), (None, fourth),  # 7 is a copy here, the first there
    ]
    docs = spark.createDataFrame([(*r, "r") for r in rows], "doc_id long, text string, rec string").repartition(3)
    left = [(r[0], lower(r[1])) for r in simhash.drop_near_copies(docs).collect()]
    want = [(None, base), (None, other), (None, ""), (5, third), (7, fourth)]
    assert sorted(left, key=repr) == sorted(((i, lower(t)) for i, t in want), key=repr)
    assert simhash.drop_near_copies(docs).columns == docs.columns
    assert simhash.drop_near_copies(none).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 700), (500, 900), (-5, 900)]
    got = dict(tuple(r) for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(201)}, **{i: -5 for i in (-5, 500, 700, 900)}}


def test_pipeline_stages_against_brute_force(spark, docs, none):
    kept = [r for r in ROWS if not base_rules(r[1])[-1]]
    stage = dict(corpus_pipeline.STAGES)
    quality = stage["quality rules"](spark, docs, "")
    assert table_of(quality) == sorted(kept, key=repr)
    best = {}
    for row in kept:
        if lower(row[1]) not in best or (row[0] or -1) > (best[lower(row[1])][0] or -1):
            best[lower(row[1])] = row
    unique = stage["exact dedup"](spark, quality, "")
    assert table_of(unique) == sorted(best.values(), key=repr)
    near = stage["SimHash near-dedup"](spark, unique, "")
    parts = brute_components([(r[0], r[1]) for r in best.values()])
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({c for _, _, c in parts})
    assert near.columns == docs.columns
    mixed = stage["source mix"](spark, near, "")
    ids = stage["SentencePiece encoding"](spark, mixed, "")
    assert ids.filter("round_trip").count() == mixed.count()
    empty = none
    for _, run in corpus_pipeline.STAGES:
        empty = run(spark, empty, "")
    assert empty.count() == 0
