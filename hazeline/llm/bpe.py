"""Fast encoders for the merge tables of `tokenizers` files.

The ids are those of the tokenizers library. Its encoder also builds offsets and masks and takes
about four times as long as a bare merge loop, so the vocabulary of the same file is handed to
tiktoken, whose ranks are merge orders. A vocabulary with word ends fits in as well: the mark of a
word's end becomes a zero byte, and a last letter with its end has a lower rank than any merge, so
it is joined first, as the library starts from it. Texts that this does not cover (special tokens
written out, zero bytes, letters that compose or whose lower case depends on their place, signs
younger than Unicode 3.2, on which libraries differ) go to the library itself. The tests compare
both over every code point.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata

import regex
import tiktoken

# fixed values: how the two files cut a text before merging
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"""
WORD_END = "</w>"
LONG_BLANK = 100_000


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable bytes are
    themselves, the others are numbered from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def settled(text: str) -> bool:
    """Whether all signs are below 256: old, composed, and lower-cased one by one."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def young_signs() -> re.Pattern:
    """Finds a sign that Unicode 3.2 does not have."""
    ranges, start = [], None
    for point in range(128, sys.maxunicode + 2):
        young = point <= sys.maxunicode and unicodedata.ucd_3_2_0.category(chr(point)) == "Cn"
        if young and start is None:
            start = point
        elif not young and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{point - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


def low_cutter():
    """`WORD_PATTERN` for signs below 256, spelled out for the faster of the two pattern engines."""
    signs = [chr(i) for i in range(256)]
    kinds = {k: re.escape("".join(c for c in signs if regex.match(rf"\{k}", c))) for k in ("s", "p{L}", "p{N}")}
    letters, digits, blank = kinds["p{L}"], kinds["p{N}"], kinds["s"]
    return re.compile(rf"[{letters}]+|[{digits}]|'(?:[stmd]|re|ve|ll)|[^{blank}{letters}{digits}]+").findall


class Encoder:
    """`encode(texts)`: the ids of each text. `special`: whether special tokens written out in a
    text are encoded as such, the library's default, or as plain text."""

    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        self.special = [t["content"] for t in data["added_tokens"] if special]
        sign, vocabulary = byte_of_sign(), data["model"]["vocab"]
        self.word_ends = data["model"]["end_of_word_suffix"] == WORD_END
        #: bytes of every id, without the mark of a word's end
        self.surface: dict[int, bytes] = {t["id"]: t["content"].encode() for t in data["added_tokens"]}
        ranks = {}
        for token, i in vocabulary.items():
            ended = self.word_ends and token.endswith(WORD_END)
            own = bytes([sign[c] for c in (token[: -len(WORD_END)] if ended else token)])
            self.surface[i] = own
            ranks[own + b"\0" if ended else own] = i
        first = len(vocabulary) - len(data["model"]["merges"])
        pairs = (m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"])
        if len(ranks) != len(vocabulary) or any(vocabulary[a + b] != first + i for i, (a, b) in enumerate(pairs)):
            raise ValueError("ids do not follow the order of the merges")
        pattern = "[^\0]+\0" if self.word_ends else BYTE_PATTERN
        self.merge = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut, self.cut_low = regex.compile(WORD_PATTERN).findall, low_cutter()
        self.young = young_signs().search if self.word_ends else None
        self.blank = regex.compile(r"\s{%d}" % LONG_BLANK).search

    def size(self) -> int:
        return max(self.surface) + 1

    def _prepared(self, text: str) -> str | None:
        """What the merge loop gets; None where only the library can tell."""
        if any(s in text for s in self.special):
            return None
        if not self.word_ends:
            return None if len(text) >= LONG_BLANK and self.blank(text) else text
        low = settled(text)
        if "\0" in text or not low and (
            "Σ" in text or self.young(text) or not unicodedata.is_normalized("NFC", text)
        ):
            return None
        words = (self.cut_low if low else self.cut)(text.lower())
        return "\0".join(words) + "\0" if words else ""

    def encode(self, texts: list[str]) -> list[list[int]]:
        prepared = [self._prepared(t) for t in texts]
        hard = [t for t, p in zip(texts, prepared) if p is None]
        slow = iter(self.library.encode_batch_fast(hard, add_special_tokens=False) if hard else ())
        fast = self.merge.encode_ordinary
        return [next(slow).ids if p is None else fast(p) for p in prepared]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """One encoder per Python worker."""
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = Encoder(path, special)
    return _ENCODERS[path, special]
