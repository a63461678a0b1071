"""Encoding and decoding with a public byte-level BPE vocabulary, in Spark's own expressions.

A text is split into words by the vocabulary's pattern. A word's bytes are merged by folding over
an array of binary pieces: each step joins the adjacent pair of lowest rank, leftmost first, until
no pair has a rank. Ranks come from one constant: an array of small maps indexed by CRC-32, so a
lookup costs a few comparisons. The corpus's most frequent words are encoded once and looked up
the same way; every other word is folded where it stands.

Defined results
* Null and empty texts give an empty list. The text is taken as it is, special-token strings too.
* Ids of repeated ``doc_id`` rows are given once per row. Extra columns are not read.
* A word of n bytes needs at most n-1 steps and 2 lookups a step, so long runs stay affordable.
"""

from __future__ import annotations

import base64
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The vocabulary's published split pattern, with Unicode's White_Space written out. Its
# alternatives start with different characters, so the most frequent one may come first, and runs
# that nothing after them can shorten are possessive.
_SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PATTERN = (
    r" ?\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]++|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]++"
)

NO_RANK = 2**31 - 1
RANK_SLOTS = 1 << 16
#: Most words whose encoding is kept ready; with at most WORD_BYTES bytes each, the constant stays below 32 MB.
READY_WORDS = 200_000
READY_BYTES = 48
READY_SLOTS = 1 << 18


def load_ranks(path: str = DEFAULT_VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _slots(entries, n: int) -> list[dict]:
    """Maps by CRC-32 of the key; empty slots are null."""
    out: list[dict | None] = [None] * n
    for k, v in entries:
        at = zlib.crc32(k if isinstance(k, bytes) else k.encode()) % n
        if out[at] is None:
            out[at] = {}
        out[at][k] = v
    return out


def _constant(spark: SparkSession, value, kind: str) -> Column:
    """A value as a scalar subquery over one row: evaluated once, then a constant in the plan.

    A subquery may not stand inside a higher-order function when a query is analysed, so callers
    select it as a column first; the optimizer then folds both projections into one, in which the
    constant is an argument and no row carries it.
    """
    return spark.createDataFrame([(value,)], f"c {kind}", verifySchema=False).scalar()


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and use it several times inside ``use``."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _find(slots: Column, n: int, key: Column) -> Column:
    return F.element_at(F.get(slots, (F.crc32(key) % n).cast("int")), key)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0))


def merge_word(word: Column, ranks: Column) -> Column:
    """Token ids of one word (binary), by folding ranked merges over its bytes."""
    rank = lambda a, b: F.coalesce(_find(ranks, RANK_SLOTS, F.concat(a, b)), F.lit(NO_RANK))

    def fold(w: Column) -> Column:
        n = F.length(w)
        at = F.sequence(F.lit(1), n)
        pieces = F.transform(at, lambda i: F.substring(w, i, 1))
        start = _let(pieces, lambda t: F.struct(t.alias("t"), F.transform(F.slice(at, 1, n - 1), lambda i: rank(F.get(t, i - 1), F.get(t, i))).alias("r")))

        def step(acc: Column, _: Column) -> Column:
            t, r = acc["t"], acc["r"]

            def merge(m: Column) -> Column:
                def join(i: Column) -> Column:
                    new = F.concat(F.get(t, i - 1), F.get(t, i))
                    tokens = F.concat(F.slice(t, F.lit(1), i - 1), F.array(new), F.slice(t, i + 2, n))
                    left = F.when(i > 1, F.array(rank(F.get(t, i - 2), new))).otherwise(F.array().cast("array<int>"))
                    right = F.when(i + 1 < F.size(t), F.array(rank(new, F.get(t, i + 1)))).otherwise(F.array().cast("array<int>"))
                    # the ranks left of i-1 stay, i-1 and i+1 are new, those right of i+1 stay
                    ranked = F.concat(F.slice(r, F.lit(1), F.greatest(i - 2, F.lit(0))), left, right, F.slice(r, i + 2, n))
                    return F.struct(tokens.alias("t"), ranked.alias("r"))

                return F.when(F.coalesce(m, F.lit(NO_RANK)) == NO_RANK, acc).otherwise(_let(F.array_position(r, m).cast("int"), join))

            return _let(F.array_min(r), merge)

        merged = F.aggregate(F.slice(at, 1, n - 1), start, step, lambda a: a["t"])
        return F.coalesce(
            F.when(_find(ranks, RANK_SLOTS, w).isNotNull(), F.array(_find(ranks, RANK_SLOTS, w))),
            F.transform(merged, lambda p: _find(ranks, RANK_SLOTS, p)),
        )

    return _let(word, fold)


def frequent_words(documents: DataFrame, most: int = READY_WORDS) -> DataFrame:
    """(word, n): the words that occur most often in all texts; ties go by the word itself."""
    w = documents.select(F.explode(words_of(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return w.filter((F.col("n") > 1) & (F.octet_length("word") <= READY_BYTES)).orderBy(F.desc("n"), "word").limit(most)


def encode(documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, ready_words: int = READY_WORDS) -> DataFrame:
    """(doc_id, ids) of every row."""
    spark = documents.sparkSession
    ranks = _constant(spark, _slots(load_ranks(vocabulary).items(), RANK_SLOTS), "array<map<binary,int>>")
    top = frequent_words(documents, ready_words)
    coded = top.select("word", ranks.alias("ranks")).select("word", _let(F.col("ranks"), lambda r: merge_word(F.encode("word", "utf-8"), r)).alias("ids"))
    ready = coded.collect()  # at most ready_words rows
    words = _constant(spark, _slots(((r[0], r[1]) for r in ready), READY_SLOTS), "array<map<string,array<int>>>")

    def ids(c: Column) -> Column:
        one = lambda w: F.coalesce(_find(c["ready"], READY_SLOTS, w), merge_word(F.encode(w, "utf-8"), c["ranks"]))
        return F.flatten(F.transform(words_of(F.col("text")), one))

    whole = documents.select("doc_id", "text", F.struct(ranks.alias("ranks"), words.alias("ready")).alias("constants"))
    return whole.select("doc_id", _let(F.col("constants"), ids).alias("ids"))


def decode(encoded: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(doc_id, text): the ids' binary pieces, concatenated and read as UTF-8; an empty list gives an empty text."""
    spark = encoded.sparkSession
    ranks = load_ranks(vocabulary)
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    table = _constant(spark, pieces, "array<binary>")
    # pieces are joined as hexadecimal text: one linear join instead of repeated binary concatenation
    joined = _let(F.col("pieces"), lambda t: F.unhex(F.array_join(F.transform("ids", lambda i: F.hex(F.get(t, i))), "")))
    return encoded.select("doc_id", "ids", table.alias("pieces")).select("doc_id", F.decode(joined, "utf-8").alias("text"))
