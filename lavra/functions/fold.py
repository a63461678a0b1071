"""Text folding shared by the Python (Arrow) stages and the JVM expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _marks() -> re.Pattern:
    """One character class with every combining mark (category Mn), as ranges."""
    spans, start = [], None
    for cp in range(0x300, sys.maxunicode + 2):
        mark = cp <= sys.maxunicode and unicodedata.category(chr(cp)) == "Mn"
        if mark and start is None:
            start = cp
        elif not mark and start is not None:
            spans.append((start, cp - 1))
            start = None
        if cp == 0x20000 and start is None:  # planes 2-13 hold no marks
            break
    spans.append((0xE0100, 0xE01EF))
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in spans) + "]+")


def fold(text: str) -> str:
    """Lower case, canonical decomposition, combining marks dropped."""
    text = text.lower()
    if text.isascii():
        return text
    return _marks().sub("", unicodedata.normalize("NFD", text))


@lru_cache(maxsize=1)
def _latin_pairs() -> tuple[str, str]:
    """Precomposed letters up to U+1EFF and their base letters, from the Unicode tables."""
    src, dst = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(cp))
        if len(base) > 1 and unicodedata.category(base[1]) == "Mn":
            src.append(chr(cp))
            dst.append(base[0])
    return "".join(src), "".join(dst)


def fold_col(text: Column) -> Column:
    """JVM-side folding for Latin text: ``translate`` for precomposed letters, then marks out."""
    src, dst = _latin_pairs()
    return F.regexp_replace(F.translate(F.lower(text), src, dst), r"\p{Mn}+", "")
