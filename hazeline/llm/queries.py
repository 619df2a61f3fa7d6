"""One registered query per operator, on its whole table, and the SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import (
    alignment, collocations, exact, language, language_model, licenses, mixing, packing, pieces, quality_rules,
    rule_ensemble, simhash, wavelet,
)
from hazeline.llm.common import table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wavelet.encoded_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicated(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("kept_share")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select(
        "rec.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placements, _ = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))
    return placements.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, piece_model = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)
    measures, _ = alignment.aligned(table(spark, sf_dir, "documents"), byte_level, piece_model)
    return measures


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_wavelet_tokens": op1_wavelet_tokens,
    "op2_recurrent_lm": op2_recurrent_lm,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_license_scan": op7_license_scan,
    "op8_source_mix": op8_source_mix,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash": op10_simhash,
    "op11_packing": op11_packing,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3_SQL = f"""
WITH hashed AS (SELECT doc_id, sha256({_LOWER}) AS h FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept,
       h AS text_sha256
FROM hashed
"""

OP5_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text, md5(coalesce(text, '')) AS page,
         {_WORDS} AS w
  FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM docs WHERE len(w) >= 8
), windows AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n
  FROM (SELECT doc_id, pos,
               word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
               || ' ' || lead(word, 4) OVER o || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o
               || ' ' || lead(word, 7) OVER o AS gram
        FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos))
  WHERE gram IS NOT NULL
), repeated AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n FROM windows, range(8) AS r(k) WHERE n > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, page, unnest(string_split(text, chr(10))) AS line FROM docs
), real_lines AS (
  SELECT doc_id, host, page, line,
         trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS plain,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM real_lines GROUP BY doc_id
), seen AS (SELECT host, plain, page, max(n) AS n FROM real_lines GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT page) AS texts FROM seen GROUP BY host),
counted AS (
  SELECT doc_id, host, page, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[{quality_rules.SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)
), good AS (
  SELECT DISTINCT host, page FROM counted
  WHERE NOT (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words)
), frequent AS (
  SELECT host, plain FROM seen JOIN hosts USING (host) GROUP BY host, plain, texts
  HAVING count(*) > {quality_rules.MAX_LINE_TEXTS} AND count(*) > {quality_rules.MAX_LINE_SHARE}::DOUBLE * texts
), held AS (
  SELECT host, page, plain, n, f.plain IS NOT NULL AS hit, sum(n) OVER p AS total,
         1 - (sum(CASE WHEN f.plain IS NULL THEN 0 ELSE n END) OVER p)::DOUBLE / (sum(n) OVER p) AS bare
  FROM seen LEFT JOIN (SELECT host, plain FROM frequent) f USING (host, plain) WINDOW p AS (PARTITION BY host, page)
), owners AS (
  SELECT host, plain, coalesce(min(page) FILTER (bare >= {quality_rules.MIN_LEFT_SHARE}::DOUBLE), min(page)) AS owner
  FROM held JOIN good USING (host, page) WHERE hit GROUP BY host, plain
), depleted AS (
  SELECT host, page FROM held LEFT JOIN owners USING (host, plain) WHERE hit
  GROUP BY host, page, total
  HAVING NOT coalesce(bool_or(owner = page), false)
    AND 1 - sum(CASE WHEN owner = page THEN 0 ELSE n END)::DOUBLE / total < {quality_rules.MIN_LEFT_SHARE}::DOUBLE
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words
         AS base_failed,
       NOT base_failed AND depleted.page IS NULL AS kept
FROM counted LEFT JOIN depleted USING (host, page)
"""

OP8_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, 
         md5(coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, ''))) AS dice FROM documents
), placed AS (
  SELECT *, lpad(length(bin(size))::VARCHAR, 2, '0') || left(bin(size), 3) AS class,
         ('0x' || left(md5('{mixing.SEED}' || coalesce(source, '')), 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM sized
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, left(dice, 2), size, dice, doc_id) AS pos FROM placed
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), ratios AS (
  SELECT *, {mixing.MAX_REPEAT}::DOUBLE * source_size AS cap, {mixing.MAX_REPEAT}::DOUBLE * source_size / weight AS ratio
  FROM sources
), levels AS (
  SELECT *, ({mixing.TOTAL_SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM ratios
  WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN ratio > level
              THEN weight * arg_min(level, ratio) FILTER (WHERE ratio > level) OVER () ELSE cap END AS target
  FROM levels
), rated AS (
  SELECT doc_id, size, source_size, target, u, pos,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM numbered JOIN targets ON numbered.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (size * least(floor(u + rate * pos) - floor(u + rate * (pos - 1)), ceil(rate)))::BIGINT AS taken
FROM rated
"""

_SIZES = range(2, collocations.MAX_WORDS + 1)
_PLAIN_UNION = " UNION ALL ".join(
    f"SELECT lang, {n} AS m, phrase{n} AS phrase, count(*) AS a FROM spans WHERE phrase{n} IS NOT NULL GROUP BY ALL"
    for n in range(1, collocations.MAX_WORDS + 1)
)
_SPANS = ", ".join(
    "word || ' ' || " + " || ' ' || ".join(f"lead(word, {k}) OVER o" for k in range(1, n)) + f" AS phrase{n}"
    for n in _SIZES
)

OP13_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, {_LOWER} AS text FROM documents
), cut AS (
  SELECT row, lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) AS piece,
         generate_subscripts(regexp_split_to_array(text, '[.,;:!?
-
]'), 1) AS number
  FROM docs
), words AS (
  SELECT row, lang, number, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT row, lang, number, regexp_extract_all(piece, '[^ 	]+') AS w FROM cut)
), spans AS (
  SELECT lang, word AS phrase1, {_SPANS} FROM words WINDOW o AS (PARTITION BY row, number ORDER BY pos)
), counts AS ({_PLAIN_UNION}),
frequent AS (SELECT * FROM counts WHERE a >= {collocations.MIN_COUNT}),
totals AS (SELECT lang, sum(a)::HUGEINT AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM frequent WHERE m > 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(list_slice(string_split(phrase, ' '), i, j), ' ') AS phrase
  FROM candidates, range(1, {collocations.MAX_WORDS + 1}) x(i), range(1, {collocations.MAX_WORDS + 1}) y(j)
  WHERE j > i AND j <= m AND j - i + 1 < m
), absorbed AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_phrases p ON c.lang = p.lang AND c.phrase = p.phrase
  WHERE 100 * p.a >= 100 * c.a
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS first,
         array_to_string(list_slice(string_split(phrase, ' '), k + 1, m), ' ') AS rest
  FROM candidates, range(1, {collocations.MAX_WORDS}) x(k) WHERE k < m
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, f.a AS l, r.a AS r, n,
         (1000::HUGEINT * c.a * n // (f.a::HUGEINT * r.a::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN counts f ON f.lang = c.lang AND f.phrase = c.first JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored ANTI JOIN absorbed USING (lang, phrase)
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n::BIGINT AS n, score
FROM lowest
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= {collocations.TOP}
"""

ORACLES = {
    "op3_exact_dedup": OP3_SQL, "op5_quality_rules": OP5_SQL, "op8_source_mix": OP8_SQL, "op13_collocations": OP13_SQL,
}
