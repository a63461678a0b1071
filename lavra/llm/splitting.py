"""Splitting oversized texts at natural boundaries, with overlap.

Two ways are offered. :func:`bisect_spans` is recursive bisection: cut at the strongest boundary
near the middle, recurse on halves above the limit less the overlap, then attach the overlaps.
:func:`scan_spans` takes pieces from the left, each as long as the boundary rules allow; a result
defined that way (as p4_found is) can't come from bisection, whose cuts depend on the middle.

Defined results
* A topic is a non-null ``topic_id``; its text is its chunks' texts in order of position, then
  chunk id (null positions first), joined by two line feeds. A null text counts as empty. Rows
  that repeat a chunk id within a topic count once; rows without a chunk id are left out.
* Topics within the limit give no rows. Positions are in code points. Other columns are not read.
* Texts are never collected: rows stream through sorted, and a topic's state is one buffer of at
  most the limit and one chunk's text. A topic of more than ``HOT`` characters is cut into blocks
  that are scanned in parallel: for every state a scan can enter a block with, the block's exit
  state and number of pieces are found first, then the states are chained, then pieces are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.session import staged

BLANKS = " \t\n\r"
STOPS = ".!?:;"
#: Characters above which a topic is scanned in parallel, and of the blocks it is cut into.
HOT, BLOCK = 4_000_000, 1_000_000
SCHEMA = "topic_id string, piece_no long, start_pos long, end_pos long"


@dataclass(frozen=True)
class Limits:
    size: int = 2400
    least: int = 400
    overlap: int = 200


def _last_blank_after(text: str, lo: int, hi: int, before: str = "") -> int:
    """Largest e in (lo, hi] with a blank at e-1 and, if given, one of ``before`` at e-2; -1 if none."""
    if not before:
        return max((e + 1 if (e := text.rfind(b, lo, hi)) >= 0 else -1) for b in BLANKS)
    return max((e + 2 if (e := text.rfind(s + b, max(lo - 1, 0), hi)) >= 0 else -1) for s in before for b in BLANKS)


def cut_end(text: str, start: int, limits: Limits) -> int:
    """End of the piece that begins at ``start`` when more than ``limits.size`` characters remain."""
    lo, hi = start + limits.least, start + limits.size
    paragraph = text.rfind("\n\n", max(lo - 1, 0), hi)
    if paragraph >= 0:
        return paragraph + 2
    for before in (STOPS, ""):
        e = _last_blank_after(text, lo, hi, before)
        if e > lo:
            return e
    return hi


def next_start(text: str, end: int, limits: Limits) -> int:
    """First position in the overlap zone after a blank, else the zone's start."""
    lo = end - limits.overlap
    found = [q for b in BLANKS if (q := text.find(b, max(lo - 1, 0), end - 1)) >= 0]
    return min(found) + 1 if found else lo


class Scanner:
    """Cuts a text that arrives in parts; ``feed`` and ``finish`` yield (start, end)."""

    def __init__(self, limits: Limits):
        self.limits, self.text, self.start, self.base = limits, "", 0, 0

    def feed(self, part: str) -> Iterator[tuple[int, int]]:
        self.text += part
        while len(self.text) - self.start > self.limits.size:
            e = cut_end(self.text, self.start, self.limits)
            yield self.base + self.start, self.base + e
            self.start = next_start(self.text, e, self.limits)
        if self.start > 1:  # one character before the start may still decide
            drop = self.start - 1
            self.text, self.base, self.start = self.text[drop:], self.base + drop, 1

    def finish(self) -> Iterator[tuple[int, int]]:
        yield self.base + self.start, self.base + len(self.text)


def scan_spans(text: str, limits: Limits = Limits()) -> list[tuple[int, int]]:
    s = Scanner(limits)
    return [*s.feed(text), *s.finish()]


def bisect_spans(text: str, limits: Limits = Limits()) -> list[tuple[int, int]]:
    """Recursive bisection, without recursion's depth: spans still too long are cut again."""
    room = limits.size - limits.overlap
    todo, done = [(0, len(text))], []
    while todo:
        a, b = todo.pop()
        if b - a <= (room if a else limits.size):
            done.append((a, b))
            continue
        mid, reach = (a + b) // 2, (b - a) // 4
        lo, hi = mid - reach, mid + reach
        cut = 0
        for marks in (("\n\n",), [s + x for s in STOPS for x in BLANKS], BLANKS):
            near = []
            for m in marks:
                left, right = text.rfind(m, lo, mid), text.find(m, mid, hi)
                near += [x + len(m) for x in (left, right) if x >= 0 and a < x + len(m) < b]
            if near:
                cut = min(near, key=lambda x: (abs(x - mid), x))
                break
        cut = cut or mid
        todo += [(cut, b), (a, cut)]
    return [(next_start(text, a, limits) if a else 0, b) for a, b in done]


def _stream(limits: Limits, make):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        topic, last, scanner, n = None, None, None, 0
        for b in batches:
            out = []
            for t, c, text in zip(b["topic_id"], b["chunk_id"], b["text"]):
                if t != topic:
                    if scanner:
                        for a, e in scanner.finish():
                            n += 1
                            out.append((topic, n, a, e))
                    topic, last, scanner, n = t, None, make(limits), 0
                    first = True
                elif c is not None and c == last:
                    continue
                for a, e in scanner.feed((text or "") if first else "\n\n" + (text or "")):
                    n += 1
                    out.append((topic, n, a, e))
                last, first = c, False
            yield pd.DataFrame(out, columns=["topic_id", "piece_no", "start_pos", "end_pos"])
        if scanner:
            yield pd.DataFrame([(topic, n + i, a, e) for i, (a, e) in enumerate(scanner.finish(), 1)], columns=["topic_id", "piece_no", "start_pos", "end_pos"])

    return run


class _Whole(Scanner):
    """Bisection needs the middle, so it holds the topic's text."""

    def feed(self, part: str) -> Iterator[tuple[int, int]]:
        self.text += part
        return iter(())

    def finish(self) -> Iterator[tuple[int, int]]:
        return iter(bisect_spans(self.text, self.limits))


def topic_lengths(chunks: DataFrame) -> DataFrame:
    """(topic_id, n): characters of each topic's joined text, from its chunks' lengths alone."""
    one = chunks.groupBy("topic_id", "chunk_id").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n"))
    return one.groupBy("topic_id").agg((F.sum("n") + 2 * (F.count(F.lit(1)) - 1)).alias("n"))


def split_topics(chunks: DataFrame, limits: Limits = Limits(), method: str = "scan", hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(topic_id, piece_no, start_pos, end_pos) of every topic above the limit.

    Only lengths are shuffled to find such topics; only their rows are moved and sorted. Bisection
    needs a topic's middle and holds its text, so it has no parallel way for hot topics.
    """
    chunks = chunks.select("topic_id", "chunk_id", "position", "text").filter("topic_id is not null and chunk_id is not null")
    long = staged(topic_lengths(chunks).filter(F.col("n") > limits.size), "p4-long")
    some_hot = method == "scan" and long.filter(F.col("n") > hot).limit(1).count() > 0
    usual = long.filter(F.col("n") <= hot) if some_hot else long
    rows = chunks.join(usual.select("topic_id"), "topic_id", "left_semi")
    rows = rows.repartition("topic_id").sortWithinPartitions("topic_id", F.col("position").asc_nulls_first(), "chunk_id", "text")
    make = {"scan": Scanner, "bisect": _Whole}[method]
    pieces = rows.select("topic_id", "chunk_id", "text").mapInPandas(_stream(limits, make), SCHEMA)
    if not some_hot:
        return pieces
    return pieces.unionByName(_split_hot(chunks.join(long.filter(F.col("n") > hot).select("topic_id"), "topic_id", "left_semi"), limits, block))


def scan_on(tail: str, text: str, limits: Limits) -> tuple[list[tuple[int, int]], int]:
    """Spans cut from ``tail + text`` when a scan stands at the tail's start, and the characters left over."""
    s, whole = 0, tail + text
    spans = []
    while len(whole) - s > limits.size:
        e = cut_end(whole, s, limits)
        spans.append((s, e))
        s = next_start(whole, e, limits)
    return spans, len(whole) - s


def transitions(before: str, text: str, limits: Limits) -> tuple[list[int], list[int]]:
    """For each number d of characters left over before a block: those left over after it, and the pieces cut.

    Scans from different starts soon meet, so each position is followed once.
    """
    whole, edge = before + text, len(before)
    known: dict[int, tuple[int, int]] = {}
    for p in range(edge, -1, -1):
        path, s = [], p
        while s not in known and len(whole) - s > limits.size:
            path.append(s)
            s = next_start(whole, cut_end(whole, s, limits), limits)
        left, n = known.get(s, (len(whole) - s, 0))
        known[s] = (left, n)
        for q in reversed(path):
            n += 1
            known[q] = (left, n)
    by_d = [known[edge - d] for d in range(edge + 1)]
    return [x for x, _ in by_d], [n for _, n in by_d]


def _split_hot(rows: DataFrame, limits: Limits, block: int) -> DataFrame:
    """Pieces of hot topics. Only chunk lengths and block states pass through one task a topic."""
    one = rows.groupBy("topic_id", "chunk_id").agg(F.min(F.struct(F.col("position").isNotNull(), "position", F.coalesce("text", F.lit("")).alias("text"))).alias("r"))
    one = staged(one.select("topic_id", "chunk_id", "r.position", "r.text"), "p4-hot")
    order = W.partitionBy("topic_id").orderBy(F.col("position").asc_nulls_first(), "chunk_id")
    sizes = one.select("topic_id", "chunk_id", "position", F.length("text").alias("n")).withColumn("k", F.row_number().over(order))
    size = F.col("n") + F.when(F.col("k") > 1, 2).otherwise(0)
    sizes = sizes.withColumn("off", F.coalesce(F.sum(size).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    placed = sizes.select("topic_id", "chunk_id", "k", "off", F.floor(F.col("off") / block).alias("block"))
    parts = one.join(placed, ["topic_id", "chunk_id"]).groupBy("topic_id", "block").agg(F.sort_array(F.collect_list(F.struct("k", "text"))).alias("p"), F.min("off").alias("off"))
    joined = F.concat(F.when(F.col("p")[0]["k"] > 1, "\n\n").otherwise(""), F.array_join(F.transform("p", lambda x: x["text"]), "\n\n"))
    blocks = staged(parts.select("topic_id", "block", "off", joined.alias("text")), "p4-blocks")
    # a block may be shorter than the limit, but not two in a row unless a topic ends there
    by = W.partitionBy("topic_id").orderBy("block")
    tails = blocks.select("topic_id", "block", F.expr(f"right(text, {limits.size})").alias("tail"))
    before = F.concat(F.coalesce(F.lag("tail", 2).over(by), F.lit("")), F.coalesce(F.lag("tail", 1).over(by), F.lit("")))
    tails = tails.select("topic_id", "block", before.alias("before"), F.lead("block").over(by).isNull().alias("last"))
    blocks = staged(blocks.join(tails, ["topic_id", "block"]).withColumn("before", F.expr(f"right(before, {limits.size})")), "p4-blocks")

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [transitions(x, t, limits) for x, t in zip(b["before"], b["text"])]
            yield pd.DataFrame({"topic_id": b["topic_id"], "block": b["block"], "left": [g[0] for g in got], "n": [g[1] for g in got]})

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        topic, d, no = None, 0, 0
        for b in batches:
            out = []
            for t, k, left, n in zip(b["topic_id"], b["block"], b["left"], b["n"]):
                if t != topic:
                    topic, d, no = t, 0, 0
                out.append((t, k, d, no))
                no, d = no + int(n[d]), int(left[d])
            yield pd.DataFrame(out, columns=["topic_id", "block", "d", "no"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t, off, text, before, last, d, no in zip(b["topic_id"], b["off"], b["text"], b["before"], b["last"], b["d"], b["no"]):
                spans, left = scan_on(before[len(before) - d :], text, limits)
                if last:
                    spans.append((d + len(text) - left, d + len(text)))
                out += [(t, no + i, off - d + s, off - d + e) for i, (s, e) in enumerate(spans, 1)]
            yield pd.DataFrame(out, columns=["topic_id", "piece_no", "start_pos", "end_pos"])

    moves = blocks.select("topic_id", "block", "before", "text").mapInPandas(states, "topic_id string, block long, left array<int>, n array<long>")
    entries = moves.repartition("topic_id").sortWithinPartitions("topic_id", "block").mapInPandas(chain, "topic_id string, block long, d int, no long")
    return blocks.join(entries, ["topic_id", "block"]).mapInPandas(cut, SCHEMA)
