"""Evaluation texts leaking into training texts.

Seeds are n-grams rare among the test items: those of one item only. They join passages of the
training texts to items; the passages are then aligned with the items by Smith-Waterman over
words, so that edited and paraphrased copies get a score as well.

Two seed lengths are used: ``short`` ones find edited copies; a window of ``exact`` words that is
unique to an item but holds no unique short seed is a seed itself, so no exact stretch is missed.

Defined results
* Words are maximal runs of a-z and 0-9 in the folded text. Null, empty and word-free texts on
  either side give nothing. Rows that repeat an item's id and text count once; two texts under one
  item id are both searched; equal texts under two ids share every seed, so neither has any.
* A null document or item id is kept as an id of its own. Extra columns are not read.
* Passages are cut where two seeds lie further apart than an item is long, so a very long text
  costs what its passages cost. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.words import END, Hashes, Splitter, portions

_MULT = np.uint64(0xD6E8FEB86659FD93)

#: Words of all items up to which the seed index is broadcast (24 bytes a word); beyond it seeds are joined by shuffle.
BROADCAST_WORDS = 2_000_000

HIT_SCHEMA = "doc_id long, item_id long, longest long, points long, score double, start_word long, end_word long"
NAMES = [c.split(" ")[0] for c in HIT_SCHEMA.split(", ")]

#: What a word gives an alignment that it matches, and what one that differs or is left out costs.
MATCH, MISS, GAP = 2, -1, -1
#: Cells of the alignments that are computed side by side.
SIDE_BY_SIDE = 300_000


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, position of each text's end): a mark that no window may hold stands after each text."""
    h = _HASHES.of(_SPLITTER.split(texts))
    return h, np.flatnonzero(h == _HASHES[END])


_SPLITTER, _HASHES = Splitter(plain=True), Hashes()


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out *= _MULT
        out += h[i : len(h) - n + 1 + i]
    out ^= out >> np.uint64(31)
    out *= _MULT
    return out


def _unique_windows(items: list[np.ndarray], owner: np.ndarray, n: int, unique: np.ndarray | None = None):
    """(hashes, item index, position) of windows that occur in one owner's texts only.

    ``unique`` names them where they were counted elsewhere.
    """
    g = [gram_hashes(h, n) for h in items]
    hs = np.concatenate([*g, np.empty(0, np.uint64)])
    it = np.repeat(np.arange(len(items)), [len(x) for x in g]) if items else np.empty(0, np.int64)
    pos = np.concatenate([*[np.arange(len(x)) for x in g], np.empty(0, np.int64)]).astype(np.int64)
    if unique is not None:
        keep = np.isin(hs, unique)
        return hs[keep], it[keep], pos[keep]
    _, inv = np.unique(hs, return_inverse=True)
    own = owner[it] if len(it) else it
    lo = np.full(inv.max(initial=-1) + 1, np.iinfo(np.int64).max)
    hi = np.full(inv.max(initial=-1) + 1, -1)
    np.minimum.at(lo, inv, own)
    np.maximum.at(hi, inv, own)
    keep = (lo == hi)[inv]
    return hs[keep], it[keep], pos[keep]


class SeedIndex:
    """Seeds of the items, sorted by hash, and the items' words."""

    def __init__(self, rows: list[tuple[int, str]], short: int, exact: int, unique: dict[int, np.ndarray] | None = None):
        self.short, self.exact = short, exact
        rows = sorted({(i, t) for i, t in rows if t}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.ids = [i for i, _ in rows]
        owners = {i: n for n, i in enumerate(dict.fromkeys(self.ids))}
        self.words = [h[:-1] for h, _ in (word_hashes([t]) for _, t in rows)]
        owner = np.array([owners[i] for i in self.ids], dtype=np.int64)
        sh, si, sp = _unique_windows(self.words, owner, short, unique and unique[short])
        eh, ei, ep = _unique_windows(self.words, owner, exact, unique and unique[exact])
        held = set(zip(si.tolist(), sp.tolist()))
        span = exact - short + 1
        bare = [k for k, (i, p) in enumerate(zip(ei.tolist(), ep.tolist())) if not any((i, p + q) in held for q in range(span))]
        self.tables = {short: self._sorted(sh, si, sp), exact: self._sorted(eh[bare], ei[bare], ep[bare])}
        order = np.argsort(eh, kind="stable")
        self.exact_sorted, self.exact_owner = eh[order], ei[order]

    def _sorted(self, h, i, p):
        o = np.argsort(h, kind="stable")
        # most windows of a text are told apart from all seeds by their lowest bits
        present = np.zeros(1 << max(10, int(len(h) * 8).bit_length()), bool)
        present[(h & np.uint64(len(present) - 1)).astype(np.int64)] = True
        return h[o], i[o], p[o], present

    def matches(self, h: np.ndarray):
        """(item index, text position) of every seed in word hashes."""
        out = []
        for n, (table, items, _, present) in self.tables.items():
            if not len(table):
                continue
            g = gram_hashes(h, n)
            at = np.flatnonzero(present[(g & np.uint64(len(present) - 1)).astype(np.int64)])
            g = g[at]
            lo, hi = np.searchsorted(table, g, "left"), np.searchsorted(table, g, "right")
            reps = hi - lo
            k = np.repeat(lo, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            out.append((items[k], np.repeat(at, reps)))
        return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64)]


def smith_waterman(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Best local alignment of each pair of word arrays: rows (points, start in b, end in b).

    All pairs are aligned side by side, one row of their matrices at a time. The row's gap recursion
    is a running maximum of values shifted by their column, so a row is a few operations on arrays.
    """
    rows, n = max(map(len, a)), max(map(len, b))
    x, y = np.full((len(a), rows), 1 << 1, np.uint64), np.full((len(a), n), 1 << 2, np.uint64)  # even: no word
    for i, (p, q) in enumerate(zip(a, b)):
        x[i, : len(p)], y[i, : len(q)] = p, q
    cols = np.arange(n + 1, dtype=np.int32)
    slope = GAP * cols
    prev = np.zeros((len(a), n + 1), np.int32)
    begun = np.broadcast_to(cols, prev.shape).copy()  # where in b the alignment that ends here began
    best = np.zeros((len(a), 3), np.int64)
    each = np.arange(len(a))
    for r in range(rows):
        diag = prev[:, :-1] + np.where(y == x[:, r, None], np.int32(MATCH), np.int32(MISS))
        up = prev[:, 1:] + np.int32(GAP)
        cur = np.zeros_like(prev)
        np.maximum(diag, up, out=cur[:, 1:])
        np.maximum(cur, 0, out=cur)
        start = begun.copy()
        start[:, 1:] = np.where(cur[:, 1:] == 0, cols[1:], np.where(diag >= up, begun[:, :-1], begun[:, 1:]))
        shifted = cur - slope
        run = np.maximum.accumulate(shifted, axis=1)
        source = np.maximum.accumulate(np.where(shifted == run, cols, 0), axis=1)
        left = run + slope
        start = np.where(left > cur, np.take_along_axis(start, source, 1), start)
        prev, begun = np.maximum(cur, left), start
        j = prev.argmax(1)
        top = prev[each, j]
        new = top > best[:, 0]
        best[new] = np.stack((top, begun[each, j], j), 1)[new]
    return best


def align(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The same for any number of pairs: those of like size are aligned side by side."""
    order = np.lexsort(([len(x) for x in a], [len(x) for x in b]))
    out = np.zeros((len(a), 3), np.int64)
    at = 0
    while at < len(order):
        end, width = at, 0
        while end < len(order):
            width = max(width, len(b[order[end]]))
            if end > at and width * (end - at + 1) > SIDE_BY_SIDE:
                break
            end += 1
        out[order[at:end]] = smith_waterman([a[k] for k in order[at:end]], [b[k] for k in order[at:end]])
        at = end
    return out


def _longest_run(mask: np.ndarray, n: int) -> int:
    """Words in the longest stretch made of consecutive windows of n words."""
    if not mask.any():
        return 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return int((edges[1::2] - edges[::2]).max()) + n - 1


def passages(index: SeedIndex, h: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
    """(text, item id, longest exact unique stretch, points, score, start word, end word): each text's best passage per item."""
    items, at = index.matches(h)
    if not len(at):
        return
    text = np.searchsorted(ends, at)
    order = np.lexsort((at, items, text))
    items, at, text = items[order], at[order], text[order]
    size = np.array([len(w) for w in index.words])
    new = (items[1:] != items[:-1]) | (text[1:] != text[:-1]) | (at[1:] - at[:-1] > size[items[1:]])
    first, last = np.concatenate(([0], np.flatnonzero(new) + 1)), np.concatenate((np.flatnonzero(new), [len(at) - 1]))
    item, text = items[first], text[first]
    begin = np.where(text > 0, ends[text - 1] + 1, 0)
    a = np.maximum(begin, at[first] - size[item])
    b = np.minimum(ends[text], at[last] + size[item] + index.exact)
    points = align([index.words[i] for i in item], [h[x:y] for x, y in zip(a, b)])
    best: dict[tuple, tuple] = {}
    for k, i in enumerate(item.tolist()):
        # a stretch of ``exact`` words gives its alignment MATCH for each, so lower ones hold none
        longest = _unique_stretch(index, h[a[k] : b[k]], i) if points[k, 0] >= MATCH * index.exact else 0
        row = (longest, int(points[k, 0]), points[k, 0] / (MATCH * size[i]), int(a[k] - begin[k] + points[k, 1]), int(a[k] - begin[k] + points[k, 2]))
        key = (int(text[k]), i)
        if key not in best or row[:2] > best[key][:2]:
            best[key] = row
    for (t, i), row in best.items():
        yield (t, index.ids[i], *row)


def _unique_stretch(index: SeedIndex, h: np.ndarray, item: int) -> int:
    """The longest stretch of windows of ``exact`` words that only this item id holds, in words."""
    g = gram_hashes(h, index.exact)
    lo = np.searchsorted(index.exact_sorted, g)
    ok = lo < len(index.exact_sorted)
    ok[ok] = index.exact_sorted[lo[ok]] == g[ok]
    ok[ok] = [index.ids[index.exact_owner[k]] == index.ids[item] for k in lo[ok]]
    return _longest_run(ok, index.exact)


def _rows(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=NAMES).astype({"doc_id": "Int64", "item_id": "Int64"})


def _search(index):
    """Direct search: seeds are looked up in a broadcast index while the texts stream by."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            docs = b["doc_id"].tolist()
            for first, texts in portions(b["text"]):
                yield _rows([(None if pd.isna(d := docs[first + t]) else d, *row) for t, *row in passages(index.value, *word_hashes(texts))])

    return run


def _seed_rows(sizes: tuple[int, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for k, text in zip(b["k"], b["text"]):
                h = word_hashes([text or ""])[0][:-1]
                for n in sizes:
                    parts.append(pd.DataFrame({"seed": np.unique(gram_hashes(h, n)).astype(np.int64)}).assign(k=k, n=n))
            if parts:
                yield pd.concat(parts)[["k", "n", "seed"]].astype({"k": "object"})

    return run


def _search_pairs(short: int, exact: int):
    """Search of one text in one item's text, with the item's unique windows (the shuffled way)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, text, item, item_text, s, e in zip(b["doc_id"], b["text"], b["item_id"], b["item_text"], b["short"], b["exact"]):
                unique = {short: np.array(s, dtype=np.int64).astype(np.uint64), exact: np.array(e, dtype=np.int64).astype(np.uint64)}
                ix = SeedIndex([(None if pd.isna(item) else item, item_text)], short, exact, unique)
                out += [(None if pd.isna(doc) else doc, *row) for _, *row in passages(ix, *word_hashes([text]))]
            yield _rows(out)

    return run


def leaked_passages(documents: DataFrame, items: DataFrame, short: int = 6, exact: int = 12, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(doc_id, item_id, longest, points, score, start_word, end_word): each text's best passage per item it shares a seed with.

    ``points`` are the alignment's; ``score`` is their share of a whole match; start and end are its
    words in the text. ``longest`` is the longest stretch of windows of ``exact`` words that only this
    item holds, in words; it is sought where the points reach those of such a stretch.
    """
    spark = documents.sparkSession
    items = items.select("item_id", "text").filter("text is not null")
    docs = documents.select("doc_id", "text").filter("text is not null")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if size <= 6 * broadcast_words:
        rows = [(r[0], r[1]) for r in items.collect()]  # bounded by the check above
        index = spark.sparkContext.broadcast(SeedIndex(rows, short, exact))
        return docs.mapInPandas(_search(index), HIT_SCHEMA)
    # Many items: their seeds are counted and joined by shuffle; a pair carries its item's unique windows.
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))  # noqa: E731  null ids are a value of their own
    docs, items = docs.withColumn("dk", key("doc_id")), items.distinct().withColumn("ik", key("item_id"))
    kinds = "k string, n int, seed long"
    grams = items.select(F.col("ik").alias("k"), "text").mapInPandas(_seed_rows((short, exact)), kinds).distinct()
    rare = grams.groupBy("n", "seed").agg(F.count(F.lit(1)).alias("c"), F.first("k").alias("ik")).filter("c = 1").select("n", "seed", "ik")
    own = rare.groupBy("ik").agg(*[F.collect_list(F.when(F.col("n") == n, F.col("seed"))).alias(c) for c, n in (("short", short), ("exact", exact))])
    seen = docs.select(F.col("dk").alias("k"), "text").mapInPandas(_seed_rows((short, exact)), kinds)
    pairs = seen.join(rare, ["n", "seed"]).select(F.col("k").alias("dk"), "ik").distinct()
    full = pairs.join(docs, "dk").join(items.select("ik", "item_id", F.col("text").alias("item_text")), "ik").join(own, "ik")
    return full.select("doc_id", "text", "item_id", "item_text", "short", "exact").mapInPandas(_search_pairs(short, exact), HIT_SCHEMA)
