"""Reading the word-end BPE vocabulary, and cutting texts into its pre-tokens.

A text is normalised (NFC, white space, lower case) and cut into contractions, letter runs, single
digits and runs of other signs. Texts of plain Latin letters take one compiled pattern; any other
text takes the library's own normaliser and pre-tokenizer, so that Unicode tables never differ.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
# Latin text up to U+017F needs no composition, and but for U+0130 each letter lowers to one letter.
_UNSAFE = re.compile("[^\x00-įı-ſ]")
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u0085 "
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_CHUNK = 1 << 20
_LONG = 64


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def specials(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def chunks(text: str) -> Iterator[str]:
    """The whole text in parts of about a million characters, cut before a blank or line end.

    No pre-token and no special token holds white space, so the parts' tokens follow each other as
    the text's do.
    """
    start = 0
    while len(text) - start > _CHUNK:
        cut = re.compile("[ \n]").search(text, start + _CHUNK)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def plain(text: str) -> bool:
    return _UNSAFE.search(text) is None


def pieces(text: str) -> list[str]:
    """Pre-tokens of plain text, in lower case."""
    return _PIECES.findall(text.lower())


class Remembered(dict):
    """Values by pre-token, computed once. Memory is bounded: when `limit` values are held, they become
    the older half, the former older half goes, and values used again come back from it."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, piece):
        value = self.older.get(piece)
        if value is None:
            value = self.make(piece)
            if len(piece) > _LONG:
                return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[piece] = value
        return value
