"""How distinctive a phrase is for its record: a parsimonious language model.

Each record's own phrases are told apart from the collection by expectation-maximisation: a
phrase keeps probability mass only as far as the record explains it better than the background.

Defined results
* A record is a distinct ``id``; rows that repeat an id count once (the largest count wins, so
  rows that differ agree on any partition layout). Null ids, texts and phrase lists give nothing.
* A phrase is its folded words; entries without a letter are dropped; entries that fold to the
  same words are one phrase. Phrases that do not occur in the text get no row.
* Empty and very long texts need no special case: a text is one flat array of word hashes.
* Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.words import END, Hashes, Splitter, portions, text_of
from lavra.session import staged

_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPLITTER, _HASHES = Splitter(plain=False), Hashes()

#: Bits of the phrase filter that is broadcast: BITS_EACH for each phrase, from 128 kB to 32 MB.
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 20, 1 << 28


def _gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of n words, by position of its first word."""
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out *= _MULT
        out += h[i : len(h) - n + 1 + i]
    out ^= out >> np.uint64(29)
    out *= _MULT
    out ^= out >> np.uint64(32)
    return out


def _own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (id, phrase, n_phrase) for the folded phrases of each record."""
    for b in batches:
        who, entries = [], []
        for i, phrases in zip(b["id"], b["phrases"]):
            some = [p for p in phrases if p] if phrases is not None else []
            who += [i] * len(some)
            entries += some
        out, one, at = [], [], 0
        for _, part in portions(entries):
            for w in _SPLITTER.split(part):
                if w != END:
                    one.append(text_of(w))
                    continue
                if one:
                    out.append((who[at], " ".join(one), len(one)))
                one, at = [], at + 1
        yield pd.DataFrame(out, columns=["id", "phrase", "n_phrase"]).drop_duplicates()


def _phrase_hash(phrase: str) -> np.uint64:
    h = _HASHES.of(_SPLITTER.split([phrase])[:-1])
    return _gram_hashes(h, len(h))[0]


def _filter_words(n_bits: int):
    """The filter's 32-bit words that a partition of phrases sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = [np.empty(0, np.int64)]
        for b in batches:
            bits.append(np.unique(np.array([int(_phrase_hash(p) % np.uint64(n_bits)) for p in b["phrase"]], dtype=np.int64)))
        at = np.unique(np.concatenate(bits))
        yield pd.DataFrame({"word": at >> 5, "bits": np.int64(1) << (at & 31)}).groupby("word", as_index=False)["bits"].sum()

    return run


def _scan(bitset, lengths: list[int]):
    """Rows (phrase, id, tf) for every window of a text that passes the filter, and one of null phrase with the text's words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words32 = bitset.value
        n_bits = np.uint64(len(words32) << 5)
        for b in batches:
            all_ids = b["id"].to_numpy()
            for first, texts in portions(b["text"]):
                words = _SPLITTER.split(texts)
                ids = all_ids[first : first + len(texts)]
                h = _HASHES.of(words)
                ends = np.flatnonzero(h == _HASHES[END])
                n_words = np.diff(ends, prepend=-1) - 1
                doc = np.repeat(np.arange(len(ends)), n_words + 1)
                docs, grams, starts, sizes = [], [], [], []
                for n in lengths:
                    if len(h) < n:
                        continue
                    g = _gram_hashes(h, n)
                    key = (g % n_bits).astype(np.int64)
                    hit = (words32[key >> 5] >> (key & 31).astype(np.uint32)) & np.uint32(1)
                    # a window that lies in one text and doesn't hold its end
                    at = np.flatnonzero((hit == 1) & (doc[: len(key)] == doc[n - 1 :]) & (ends[doc[n - 1 :]] >= np.arange(n, len(h) + 1)))
                    docs.append(doc[at])
                    grams.append(g[at])
                    starts.append(at)
                    sizes.append(np.full(len(at), n))
                found = pd.DataFrame({k: np.concatenate([*x, np.empty(0, t)]) for k, x, t in (("d", docs, np.int64), ("g", grams, np.uint64), ("at", starts, np.int64), ("n", sizes, np.int64))})
                found = found.groupby(["d", "n", "g"], as_index=False, sort=False).agg(at=("at", "first"), tf=("at", "size"))
                # words are written out once for each text and phrase
                phrases = [text_of(words[i]) if n == 1 else " ".join(map(text_of, words[i : i + n])) for i, n in zip(found["at"].tolist(), found["n"].tolist())]
                yield pd.DataFrame({"phrase": pd.Series(phrases, dtype=object), "id": ids[found["d"].to_numpy(dtype=np.int64)], "tf": found["tf"].astype(np.int64)})
                yield pd.DataFrame({"phrase": pd.Series([None] * len(ids), dtype=object), "id": ids, "tf": n_words.astype(np.int64)})

    return run


def parsimonious(terms: Column, rest_tf: Column, rest_pc: Column, rounds: int, record_share: float) -> Column:
    """Converged P(term | record) for an array of struct(phrase, tf, pc, ...), in array order.

    E: e = tf * s*p / (s*p + (1-s)*pc); M: p = e / sum(e). All other words of the record are one
    more term with count ``rest_tf`` and background ``rest_pc``.
    """
    s = F.lit(record_share)
    tf = F.concat(F.transform(terms, lambda t: t["tf"].cast("double")), F.array(rest_tf))
    pc = F.concat(F.transform(terms, lambda t: t["pc"]), F.array(rest_pc))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    start = F.transform(tf, lambda x: x / F.greatest(total(tf), F.lit(1.0)))

    def step(p, _):
        e = F.zip_with(F.zip_with(tf, pc, lambda a, b: F.struct(a.alias("tf"), b.alias("pc"))), p,
                       lambda x, q: F.when(q > 0, x["tf"] * s * q / (s * q + (1 - s) * x["pc"])).otherwise(0.0))
        # the sum is taken once per round: kept in a one-element array and mapped over
        return F.flatten(F.transform(F.array(e), lambda ee: F.transform(F.array(F.greatest(total(ee), F.lit(1e-300))), lambda z: F.transform(ee, lambda x: x / z))))[0]

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


def phrase_statistics(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(own, corpus, sizes) for records (id, text, phrases).

    own: (id, phrase, tf, n_phrase) of the phrases found in their record's text; corpus: (phrase,
    df, cf) over the texts of all records; sizes: (id, n_words). Each text is read once.
    """
    spark = records.sparkSession
    records = records.filter(F.col("id").isNotNull())
    cand = staged(records.filter(F.size("phrases") > 0).select("id", "phrases").mapInPandas(_own, "id string, phrase string, n_phrase int").distinct(), "p1-own")
    phrases = staged(cand.select("phrase", "n_phrase").distinct(), "p1-phrases")
    lengths = sorted(r[0] for r in phrases.select("n_phrase").distinct().collect())
    n_bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * phrases.count()).bit_length()))
    table = np.zeros(n_bits >> 5, np.uint32)
    if lengths:
        bits = phrases.select("phrase").mapInPandas(_filter_words(n_bits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        got = bits.toPandas()  # at most MOST_BITS / 32 rows
        table[got["word"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    scan = _scan(spark.sparkContext.broadcast(table), lengths)
    seen = records.select("id", "text").mapInPandas(scan, "phrase string, id string, tf long")
    seen = staged(seen.groupBy("phrase", "id").agg(F.max("tf").alias("tf")), "p1-seen")
    own = cand.join(seen.filter("phrase is not null"), ["id", "phrase"])
    corpus = seen.filter("phrase is not null").groupBy("phrase").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    return own, corpus, seen.filter("phrase is null").select("id", F.col("tf").alias("n_words"))


def distinctive_phrases(records: DataFrame, rounds: int = 15, record_share: float = 0.1) -> DataFrame:
    """(id, phrase, tf, df, cf, probability, weight, rank) for each own phrase found in its record's text.

    ``probability`` is the converged P(phrase | record). ``weight`` is the same for phrases shared
    with other records and 0 for phrases found nowhere else, so these fall behind; ties in rank
    go by phrase.
    """
    own, corpus, sizes = phrase_statistics(records)
    size = sizes.agg(F.greatest(F.sum("n_words"), F.lit(1)).cast("double").alias("w"))
    t = own.join(corpus, "phrase").crossJoin(F.broadcast(size))  # one row
    t = t.withColumn("pc", F.col("cf") / F.col("w"))
    g = t.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("phrase", "tf", "df", "cf", "pc", "n_phrase"))).alias("t")).join(sizes, "id")
    covered = F.aggregate("t", F.lit(0), lambda a, x: a + (x["tf"] * x["n_phrase"]).cast("int"))
    rest_tf = F.greatest(F.col("n_words") - covered, F.lit(0)).cast("double")
    rest_pc = F.greatest(1 - F.aggregate("t", F.lit(0.0), lambda a, x: a + x["pc"]), F.lit(0.0))
    g = g.withColumn("p", parsimonious(F.col("t"), rest_tf, rest_pc, rounds, record_share))
    scored = F.zip_with("t", F.slice("p", 1, F.size("t")), lambda x, p: F.struct(
        F.when(x["df"] > 1, -p).otherwise(0.0).alias("order"), x["phrase"].alias("phrase"), x["tf"].alias("tf"), x["df"].alias("df"), x["cf"].alias("cf"), p.alias("probability")))
    e = g.select("id", F.posexplode(F.array_sort(scored)).alias("pos", "x"))
    return e.select("id", "x.phrase", "x.tf", "x.df", "x.cf", "x.probability", (-F.col("x.order")).alias("weight"), (F.col("pos") + 1).alias("rank"))
