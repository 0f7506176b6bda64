"""Cuts text into words that a word-end BPE tokenizer encodes independently of each other.

The tokenizer drops white space and lower-cases, so white space always separates. Closing
punctuation behind a run of plain letters is cut off as well: a run of letters never joins what
follows it there. Special strings hold characters outside that set and stay whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import cache

#: Latin letters in UTF-8 (ASCII after lower-casing, and U+00C0 to U+00FF without the two signs).
_LETTERS = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++"
_WORD = re.compile(_LETTERS + rb"(?=[.,;:!?*#$%&\x09-\x0d\x20]|\Z)|[^\x09-\x0d\x20]+")
_PLAIN = re.compile(_LETTERS)
#: Special strings are matched before lower-casing, so a text with one keeps its case.
_SPECIAL = b"<|"


def pieces(text: bytes) -> list[bytes]:
    """What white space separates in a text in UTF-8, lower-cased in ASCII."""
    return (text if _SPECIAL in text else text.lower()).split()


def words(piece: bytes) -> list[bytes]:
    """The words of a piece; most pieces are one."""
    return [piece] if piece.isalpha() else _WORD.findall(piece)


def split(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, lower-cased in ASCII."""
    return _WORD.findall(text if _SPECIAL in text else text.lower())


def fresh(path: str):
    """The tokenizer of a vocabulary file, without threads of its own, truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def load(path: str):
    """The one tokenizer of a vocabulary file in this process, for use as it is."""
    return fresh(path)


@cache
def _letters(path: str) -> dict[int, str]:
    """What the model of a vocabulary file reads for each letter outside ASCII."""
    normal, cut = load(path).normalizer.normalize_str, load(path).pre_tokenizer.pre_tokenize_str
    return {n: cut(normal(chr(n)))[0][0] for n in range(0xC0, 0x100) if _PLAIN.fullmatch(chr(n).encode())}


def encoder(path: str) -> Callable[[bytes], list[int]]:
    """Encodes one word, or any piece of text, in UTF-8.

    A word of plain letters goes straight to the library's model: normalizing and cutting leave such
    a word whole and turn its letters into others one by one.
    """
    whole, model, letters = load(path).encode, load(path).model.tokenize, _letters(path)

    def ids(word: bytes) -> list[int]:
        if not _PLAIN.fullmatch(word):
            return whole(word.decode(), add_special_tokens=False).ids
        text = word.decode()
        return [token.id for token in model(text if text.isascii() else text.translate(letters))]

    return ids


def encode(path: str, words: list[str]) -> list[list[int]]:
    return [e.ids for e in load(path).encode_batch(words, add_special_tokens=False)]
