"""Text normalisation and table access shared by the operators of this subpackage.

Null texts count as empty everywhere. ASCII capitals only are lower-cased, so a text keeps its
other code points.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other code point as it is.

    `lower` gives just that where no other capital occurs, and is far faster than `translate`.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    other_capitals = text.rlike(r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]")
    letters = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).when(other_capitals, letters).otherwise(F.lower(text))


def split_words(text: Column) -> Column:
    """Runs of anything but the six ASCII white-space characters; none in an empty text."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, WHITE_RUN))).cast("long")


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once, also where `body` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_text(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves `rest`."""
    return F.crc32(id_text(doc_id)) % modulus == rest


def text_slices(texts, limit: int) -> Iterator[tuple[int, list[str]]]:
    """(start, texts) in runs of about `limit` UTF-8 bytes or one longer text, so that the Python
    copies of a large Arrow batch never exist at once."""
    total = np.cumsum(np.concatenate([[0], pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)]))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + limit, side="right")) - 1)
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop
