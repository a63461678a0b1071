"""Per-document text statistics, and the decision between prose, list, table and junk.

Every line is given a form from its own shape and its block's: rows of cells, short entries,
running text, or nothing readable. Running text must also pass for language: share of common
words, odd symbols, repetition. The document takes the form with the most characters.

Common words are counted: those that a share of all documents hold, besides a fixed list of function
words for collections too small to tell. A text must hold half as many of them as the collection does.

Defined results
* Null, empty and blank texts have zero statistics and a null kind.
* Ties between forms go to prose, then list, table, junk. Repeated rows give repeated results.
* Whole texts are read, once, at a cost that grows with their length. Extra columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.words import END, KEPT, Splitter, portions, text_of
from lavra.session import staged

# Frequent function words of Portuguese, Spanish and English, folded to lower case.
COMMON = frozenset(
    """
    a ao aos as até com como da das de do dos e é em entre essa esse esta está este foi há isso isto já mais mas na não nas
    nem no nos o os ou para pela pelo pelas pelos por pois porque qual quando que se sem ser seu seus só sobre sua também tem um uma sim cada
    al antes con cuando del después desde el ella en es esta este fue hasta la las le lo los más muy ni otra otro para pero por
    qué se ser si sin son su sus tuvo una uno unos y ya
    after and any are at be been before but by can each for from had has have if in into is it its may more must no not of off on
    or other out over so than that the their them then there these they this to was were when which while will with without you
    depois mesmo pode precisa deve apenas caso após durante embora enquanto conforme debe puede didn't doesn't don't
    """.split()
)

BULLET = re.compile(r"\s*(?:[-*•+·–—◦▪►]+|\[[ xX]?\]|\(?\d{1,3}(?:\s?[.)ºª°]|\s-)|\(?[a-zA-Z][.)])\s+(?=\S)")
HEX_DUMP = re.compile(r"\s*(?:[0-9a-f]{4,16}:?\s+)?(?:[0-9a-f]{2,4}\s+){5,}[0-9a-f]{2,4}\s*(?:\|.*)?$", re.I)
QUOTE = re.compile(r"\s*(?:>\s?)+")
GAP = re.compile(r"\S(?: {2,}|\t)(?=\S)")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
PLAIN_MARKS = ".,;:!?'\"()-–/%“”’ºª°…\n\r\t \xa0"
NOT_ODD = re.compile(rf"[\w{re.escape(PLAIN_MARKS)}]+")
NOT_SYMBOL = re.compile(r"[\w\s]+")
BEYOND_LATIN = re.compile("[\u0250-\U0010ffff]+")
LETTERS = re.compile(r"[^\W\d_]+")
LONG_TOKEN = 40
END_MARKS = (".", "!", "?", ":", ";", "…")
SENTENCE_END = re.compile(r"[.!?](?:\s|$)")
INLINE_MARKS = (" / ", " | ", " • ", " · ", "; ", ";", " - ", " – ", ", ")
VOWELS = "aeiouyáàâãéêíóôõúü"

#: Shares and sizes the rules compare with.
ENTRY_CHARS, ENTRY_WORDS, MIN_COMMON, MAX_ODD, MIN_DISTINCT = 75, 9, 0.16, 0.08, 0.12
#: A word is common when this share of the documents hold it, three at least. So there are at most as
#: many as a document has different words on average, divided by the share.
COMMON_SHARE, COMMON_LEAST = 0.005, 3


@dataclass(frozen=True)
class Vocabulary:
    """Common words, and the share of a text's words that must be among them."""

    words: frozenset[str] = COMMON
    least: float = MIN_COMMON



STATS = (
    "words long, mean_word_length double, symbol_ratio double, lines long, end_mark_share double, common_share double,"
    " duplicate_line_share double, duplicate_paragraph_share double, top_gram_share double"
)
SCHEMA = f"doc_id long, kind string, {STATS}"


_VOWEL_BYTES = (VOWELS + VOWELS.upper()).encode("latin-1")


def _vowels(text: str) -> int:
    data = text.encode("latin-1", "ignore")
    return len(data) - len(data.translate(None, _VOWEL_BYTES))


def _odd_share(text: str) -> float:
    return (len(NOT_ODD.sub("", text)) + text.count("_")) / max(1, len(text))


_TABLE = Splitter(plain=False, folded=False).table.replace(b"\x00", b" ")


def words_in(text: str) -> list[str]:
    """Lower-case words: runs of letters, with what follows an apostrophe."""
    if "'" not in text and "’" not in text:
        try:
            return text.encode("latin-1", "lavra-blank").translate(_TABLE).decode("latin-1").split()
        except UnicodeEncodeError:
            pass
    return WORD.findall(text.lower())


def _foreign(text: str) -> int:
    """Letters beyond those of Latin scripts."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return sum(c.isalpha() for run in BEYOND_LATIN.findall(text) for c in run)
    return 0


def readable(text: str, words: list[str], known: Vocabulary = Vocabulary(), plain: bool = False) -> bool:
    """Does running text, with these lower-case words, pass for language? ``plain`` text is known to hold no odd symbol."""
    n = len(words)
    letters = sum(map(len, words))
    solid = max(1, len(text) - text.count(" ") - text.count("\n"))
    tokens = text.split()
    if max(map(len, tokens), default=0) >= LONG_TOKEN and sum(len(t) for t in tokens if len(t) >= LONG_TOKEN and "/" not in t[:8] and "@" not in t) > 0.5 * solid:
        return False
    if letters < 0.5 * solid or (not plain and _odd_share(text) > MAX_ODD):
        return False
    longer = [w for w in words if len(w) > 1]  # shuffled letters leave one-letter words whole
    common = sum(map(known.words.__contains__, longer))
    # one word can only fill more than half where at most half of the words are different
    if n >= 12 and (kinds := len(set(words))) <= 0.5 * n + 1 and (kinds < MIN_DISTINCT * n or Counter(words).most_common(1)[0][1] > 0.5 * n):
        return False
    if n >= 8:
        if common + 1 < known.least * len(longer):  # one more, as a single sentence may hold few
            return False
    if n and _vowels("".join(words)) < 0.2 * letters:
        return False
    # letters that Latin texts hardly use, cut words and capitals inside words mark garbling
    return _foreign(text) <= 0.3 * max(1, letters)


def unquoted(line: str) -> str:
    """A line without the marks that quote it; a line of such marks only stays."""
    if ">" not in line[:12]:
        return line
    m = QUOTE.match(line)
    return line[m.end() :] or line if m else line


def _cells(line: str) -> dict[str, int]:
    """Cells of a line by each way rows are written; only ways that give two or more."""
    s = line.strip()
    out = {}
    if "|" in s:
        out["|"] = len(s.strip("|").split("|"))
    if "\t" in line.strip(" \r\n"):
        out["\t"] = len(line.strip(" \r\n").split("\t"))
    if ";" in s.rstrip(";") or s.count(";") > 1:
        out[";"] = s.count(";") + 1
    if s.startswith('"') and '","' in s:
        out['"'] = s.count('","') + 1
    elif ", " not in s and s.count(",") > 1:
        out[","] = s.count(",") + 1
    gaps = len(GAP.findall(s)) if "  " in s or "\t" in s else 0
    if gaps and "\t" not in out and not _wide_text(s, gaps):
        out["  "] = gaps + 1
    return {k: v for k, v in out.items() if v > 1}


def _wide_text(line: str, gaps: int) -> bool:
    """Running text whose words are set wide apart."""
    words = line.lower().split()
    even = "   " not in line and "\t" not in line  # columns are padded, so their gaps differ
    return even and len(words) >= 5 and gaps >= 0.8 * (len(words) - 1) and sum(map(COMMON.__contains__, words)) >= 0.15 * len(words)


def _inline_list(line: str) -> bool:
    """One line of many short entries set off by the same mark."""
    at = line.find(":", 0, 160)
    body = line[at + 1 :] if 0 <= at < len(line) - 61 else line
    for mark in INLINE_MARKS:
        if body.count(mark) >= 4:
            parts = body.split(mark)
            sizes = sorted(len(WORD.findall(p)) for p in parts)
            if sizes[len(sizes) // 2] <= 4 and sizes[int(len(sizes) * 0.9)] <= 8 and len(SENTENCE_END.findall(body)) <= 0.34 * len(parts):
                return True
    return False


def line_forms(lines: list[str], plain: bool = False) -> list[str]:
    """A form for each non-blank line without quotes: table, list, short, text or junk; ``plain`` lines hold no odd symbol but those between cells."""
    cells = [_cells(x) for x in lines]
    rows: Counter = Counter()
    for c in cells:
        for k, v in c.items():
            rows[k, v] += 1
    by_mark = Counter()
    for (k, v), n in rows.items():
        by_mark[k] += n
    forms = []
    for x, c in zip(lines, cells):
        s = x.strip()
        if HEX_DUMP.match(s):
            forms.append("junk")
            continue
        b = BULLET.match(x)
        if not plain and not b and len(s) >= 2 and _odd_share(s.replace("|", "").replace('"', "").replace(";", "")) > 0.2:
            forms.append("junk")
            continue
        # fixed-width rows may miss cells, so any count goes; other marks must repeat their count
        is_row = any((by_mark["  "] >= 3 if k == "  " else (rows[k, v] >= 3 and (v >= 3 or k != ";"))) for k, v in c.items())
        if is_row and not (b and max(c.values()) < 3) and not (set(c) == {";"} and max(c.values()) < 3):
            forms.append("table")
        elif b and len(s) - b.end() <= ENTRY_CHARS:
            forms.append("list")
        elif _inline_list(s):
            forms.append("list")
        elif len(s) <= ENTRY_CHARS and len(WORD.findall(s)) <= ENTRY_WORDS:
            forms.append("short")
        else:
            forms.append("text")
    return forms


def _flows(block: list[str]) -> tuple[int, int]:
    """(lines that end without a mark, those of them whose next line goes on in lower case)."""
    ends = [j for j in range(len(block) - 1) if not block[j].rstrip().endswith(END_MARKS)]
    joined = "".join(block)
    if joined.isupper() and sum(map(COMMON.__contains__, " ".join(block).lower().split())) >= 0.2 * len(" ".join(block).split()):
        return len(ends), len(ends)  # capitals don't show where a sentence goes on; its function words do
    return len(ends), sum(block[j + 1].lstrip()[:1].islower() for j in ends)


def _settle(lines: list[str], forms: list[str]) -> list[str]:
    """Blocks of short and text lines become entries or running text by how their lines end and flow.

    Marked lines that go on from one to the next in lower case are wrapped text, too.
    """
    out = list(forms)
    i = 0
    for form, run in groupby(forms):
        n = len(list(run))
        if form == "list" and n >= 2 and not all(x.rstrip().endswith(END_MARKS) for x in lines[i : i + n - 1]):
            bare = [BULLET.sub("", x, count=1) for x in lines[i : i + n]]
            ends, flow = _flows(bare)
            if ends and flow > 0.5 * (n - 1) and median(map(len, bare)) > 24:
                out[i : i + n] = ["text"] * n
        i += n
    i = 0
    for loose, run in groupby(forms, key=lambda f: f in ("short", "text")):
        n = len(list(run))
        if loose:
            block = lines[i : i + n]
            short = [j for j in range(n) if forms[i + j] == "short"]
            if short:
                sizes = [len(block[j].strip()) for j in short]
                # wrapped text: lines nearly as long as the widest, next line going on in lower case
                open_ends, flow = _flows(block)
                words = median(len(WORD.findall(block[j])) for j in short)
                wrapped = open_ends and (flow > 0.3 * open_ends and median(sizes) > 24 or flow > 0.6 * open_ends and max(map(len, block)) > 45)
                entries = len(short) >= 3 and not wrapped and (words <= 5 or median(sizes) <= 40)
                for j in short:
                    out[i + j] = "list" if entries else "text"
        i += n
    return out


def kind_and_stats(text: str | None, known: Vocabulary = Vocabulary()) -> tuple:
    if not text or not text.strip():
        return (None, 0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0, 0.0)
    flat = unicodedata.normalize("NFC", text).replace("\r\n", "\n").replace("\r", "\n")
    lines = [x for x in flat.split("\n") if x.strip()]
    stripped = [x.strip() for x in lines]
    words = words_in(flat)
    n = len(words)
    solid = max(1, sum(map(len, flat.split())))
    symbols = (len(NOT_SYMBOL.sub("", flat)) + flat.count("_")) / solid
    ends = sum(x.endswith(END_MARKS) for x in stripped) / len(lines)
    common = sum(map(known.words.__contains__, words)) / max(1, n)
    counts = Counter(stripped)
    dup_lines = sum(len(x) * (k - 1) for x, k in counts.items()) / max(1, sum(map(len, stripped)))
    paragraphs = [p.strip() for p in re.split(r"\n\s*\n", flat) if p.strip()]
    dup_paragraphs = sum(len(p) * (k - 1) for p, k in Counter(paragraphs).items()) / max(1, sum(map(len, paragraphs)))
    gram, times = Counter(zip(words, words[1:], words[2:])).most_common(1)[0] if n > 2 else ((), 0)
    top_gram = min(1.0, times * sum(map(len, gram)) / solid) if times > 1 else 0.0
    stats = (n, sum(map(len, words)) / max(1, n), symbols, len(lines), ends, common, dup_lines, dup_paragraphs, top_gram)

    share: Counter = Counter()
    if (len(lines) >= 5 and dup_lines > 0.75) or (len(paragraphs) >= 5 and dup_paragraphs > 0.75) or (n >= 12 and top_gram > 0.4):
        share["junk"] = len(flat)
    else:
        odd = NOT_ODD.sub("", flat)
        plain = not odd and "_" not in flat
        bare = [unquoted(x) for x in lines]
        forms = _settle(bare, line_forms(bare, plain or ("_" not in flat and not odd.strip('|";'))))
        i = 0
        for form, run in groupby(forms):
            k = len(list(run))
            block = "\n".join(lines[i : i + k])
            size = len(block)
            if form == "text" and not readable(block, words if k == len(lines) else words_in(block), known, plain):
                form = "junk"
            elif form == "list" and not _entries_readable(block):
                form = "junk"
            share[form] += size
            i += k
    kind = max(("prose", "list", "table", "junk"), key=lambda f: share["text" if f == "prose" else f])
    return (kind, *stats)


def _entries_readable(block: str) -> bool:
    letters = sum(map(len, LETTERS.findall(block)))
    vowels = _vowels(block)
    return _odd_share(block.replace("[", "").replace("]", "").replace("*", "").replace("+", "").replace("•", "").replace("|", "")) <= 0.15 and (letters < 8 or vowels >= 0.2 * letters)


_SPLITTER = Splitter(plain=False, folded=False)


class Places(dict):
    """A number for every word met so far, from 0 on; the end mark is 0."""

    def __missing__(self, word: bytes | str) -> int:
        self[word] = n = len(self)
        return n


def _word_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, docs, times) of a partition's texts, in parts of about ``KEPT`` words; words of two letters or more."""
    places, docs, times = Places({END: 0}), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows() -> pd.DataFrame:
        f = pd.DataFrame({"word": list(map(text_of, places)), "docs": docs, "times": times})
        return f[f["word"].str.len() > 1]

    for b in batches:
        for _, texts in portions(b["text"]):
            words = _SPLITTER.split(texts)
            at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
            doc = np.cumsum(at == 0)
            seen = np.unique(at * (len(texts) + 1) + doc) // (len(texts) + 1)
            docs = np.concatenate((docs, np.zeros(len(places) - len(docs), np.int64))) + np.bincount(seen, minlength=len(places))
            times = np.concatenate((times, np.zeros(len(places) - len(times), np.int64))) + np.bincount(at, minlength=len(places))
            if len(places) > KEPT:
                yield rows()
                places, docs, times = Places({END: 0}), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(docs):
        yield rows()


def common_words(documents: DataFrame, share: float = COMMON_SHARE) -> Vocabulary:
    """The words that a share of all documents hold, with half the share of all words that they make up."""
    counts = documents.filter("text is not null").select("text").mapInPandas(_word_rows, "word string, docs long, times long")
    counts = staged(counts.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times")), "p9-words")
    least = max(COMMON_LEAST, share * documents.filter("text is not null").count())
    is_common = (F.col("docs") >= least) | F.col("word").isin(*sorted(COMMON))
    total, held = counts.agg(F.sum("times"), F.sum(F.when(is_common, F.col("times")))).first()
    words = [r[0] for r in counts.filter(F.col("docs") >= least).select("word").collect()]  # bounded as COMMON_SHARE says
    return Vocabulary(COMMON | frozenset(words), max(MIN_COMMON, 0.5 * (held or 0) / (total or 1)))


def text_quality(documents: DataFrame) -> DataFrame:
    """(doc_id, kind, statistics...) of every row."""
    names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    shared = documents.sparkSession.sparkContext.broadcast(common_words(documents))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f = pd.DataFrame([(d, *kind_and_stats(t, shared.value)) for d, t in zip(b["doc_id"], b["text"])], columns=names)
            yield f.astype({"doc_id": "Int64"})

    return documents.select("doc_id", "text").mapInPandas(run, SCHEMA)
