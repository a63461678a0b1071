"""Words of whole batches of texts, split as bytes.

Texts in Latin-1, but for marks and symbols beyond it, are folded and split by one table over their
bytes; any other text is folded first. The words are those of the folded text either way.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

from lavra.functions.fold import fold

#: Characters that are split at once, and words whose hashes are kept.
CHARS, KEPT = 2_000_000, 1_000_000
END = b"\x00"


def _blank(e: UnicodeEncodeError) -> tuple[str, int]:
    """Characters beyond Latin-1 end a word, unless folding may turn them into letters."""
    if any(unicodedata.category(c)[0] in "LM" for c in e.object[e.start : e.end]):
        raise e
    return " ", e.end


codecs.register_error("lavra-blank", _blank)


def _table(inside, change) -> bytes:
    """Each Latin-1 byte's folded letter where it is part of a word, a blank elsewhere; the end mark stays."""
    out = bytearray(b" " * 256)
    for i in range(256):
        c = change(chr(i))
        if len(c) == 1 and ord(c) < 256 and inside(c):
            out[i] = ord(c)
    out[0] = 0
    return bytes(out)


def _composed(text: str) -> str:
    return unicodedata.normalize("NFC", text).lower()


class Splitter:
    """Words of folded texts: runs of letters, or runs of a-z and 0-9 where ``plain``; accents stay in lower case where they are not ``folded``."""

    def __init__(self, plain: bool, folded: bool = True):
        self.plain, self.change = plain, fold if folded else _composed
        self.table = _table(lambda c: c.isascii() and c.isalnum() if plain else unicodedata.category(c)[0] == "L", self.change)

    def _bytes(self, text: str) -> bytes | list[str]:
        try:
            return text.encode("latin-1", "lavra-blank")
        except UnicodeEncodeError:
            folded = self.change(text)
        if self.plain:
            return folded.encode("ascii", "replace")
        try:
            return folded.encode("latin-1", "lavra-blank")
        except UnicodeEncodeError:
            return re.findall(r"[^\W\d_]+", _letters_only(folded))

    def split(self, texts: list[str]) -> list:
        """All words, with ``END`` after each text; words are Latin-1 bytes, or strings where these can't hold them."""
        out: list = []
        parts: list[bytes] = []
        for t in texts:
            b = self._bytes(t.replace("\x00", " ") if "\x00" in t else t) if t else b""
            if isinstance(b, bytes):
                parts.append(b)
            else:
                out += self._cut(parts)
                parts = []
                out += [w.encode("latin-1") if w.isascii() else w for w in b]
                out.append(END)
        return out + self._cut(parts)

    def _cut(self, parts: list[bytes]) -> list[bytes]:
        return b" \x00 ".join([*parts, b""]).translate(self.table).split() if parts else []


def _letters_only(text: str) -> str:
    """Characters of other categories than letters as blanks (``\\w`` holds marks and numbers as well)."""
    return "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text)


def text_of(word: bytes | str) -> str:
    return word if isinstance(word, str) else word.decode("latin-1")


class Hashes(dict):
    """Hash of every word met so far: odd numbers, the end mark is 2."""

    def __missing__(self, word: bytes | str) -> int:
        if len(self) > KEPT:
            self.clear()
        h = 2 if word == END else xxhash.xxh64_intdigest(text_of(word)) | 1
        self[word] = h
        return h

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def portions(texts: Iterable[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of about ``CHARS`` characters each; nulls are empty."""
    part: list[str] = []
    size = first = 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        part.append(t)
        size += len(t) + 50
        if size > CHARS:
            yield first, part
            part, size, first = [], 0, i + 1
    if part:
        yield first, part
