"""Documents that are copies or older versions of others, by shared word shingles.

Shared shingles are those of at most ``max_df`` documents, so a shingle makes at most a bounded
number of pairs and no document list grows without limit; shingles are carried as 64-bit hashes.
Null and empty texts have no shingle and are never copies. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions import patterns as P
from lavra.functions.text import codes
from lavra.session import staged

WORD = r"[\p{L}\p{N}_]+"


def shingles(text: Column, size: int = 5) -> Column:
    """Distinct windows of ``size`` words of the lower-cased text without markers."""
    words = F.regexp_extract_all(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), P.MARKER.lower(), " "), F.lit(WORD), F.lit(0))
    grams = F.transform(F.array(words), lambda w: F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))))[0]
    return F.array_distinct(F.coalesce(grams, F.array().cast("array<string>")))


def shingle_table(documents: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, shingle) with hashed shingles."""
    return documents.select("doc_id", F.explode(shingles(F.col("text"), size)).alias("s")).select("doc_id", F.xxhash64("s").alias("shingle"))


def shingle_frequency(documents: DataFrame) -> DataFrame:
    """(shingle, df) as text."""
    return documents.select(F.explode(shingles(F.col("text"))).alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))


def overlaps(documents: DataFrame, max_df: int = 20) -> tuple[DataFrame, DataFrame]:
    """(sizes, pairs): sizes (doc_id, size), and pairs (a, b, n) of shared rare shingles with a < b."""
    t = staged(shingle_table(documents), "shingles")
    sizes = t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("size"))
    # counting first drops boilerplate before any list is made, so lists are at most max_df long
    rare = t.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df").between(2, max_df)).select("shingle")
    lists = t.join(rare, "shingle").groupBy("shingle").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    pair = F.expr("flatten(transform(ids, (a, i) -> transform(slice(ids, i + 2, greatest(size(ids) - i - 1, 0)), b -> named_struct('a', a, 'b', b))))")
    pairs = lists.select(F.explode(pair).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))
    return sizes, pairs


def copy_candidates(documents: DataFrame, min_overlap: float = 0.6, min_ratio: float = 0.7, least: int = 30, max_df: int = 20) -> DataFrame:
    """(dropped, kept, n): accepted directed pairs; ``documents`` has doc_id, name and text.

    A copy has ``least`` shingles, shares ``min_overlap`` of them, and is no longer than the other,
    but of similar size. Of equal sizes the one with the smaller (name, id) is the copy. Names that
    carry different program codes exclude each other.
    """
    sizes, pairs = overlaps(documents, max_df)
    names = documents.select("doc_id", F.coalesce("name", F.lit("")).alias("name"), codes(F.col("name")).alias("codes")).join(sizes.filter(F.col("size") >= least), "doc_id")
    side = lambda s: names.select(*[F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "name", "codes", "size")])
    p = pairs.join(side("a"), F.col("a") == F.col("doc_id_a")).join(side("b"), F.col("b") == F.col("doc_id_b"))
    first = F.struct("size_a", "name_a", "doc_id_a") < F.struct("size_b", "name_b", "doc_id_b")
    pick = lambda c, small: F.when(first, F.col(f"{c}_{'a' if small else 'b'}")).otherwise(F.col(f"{c}_{'b' if small else 'a'}"))
    p = p.select(pick("doc_id", True).alias("dropped"), pick("doc_id", False).alias("kept"), "n", pick("size", True).alias("s"), pick("size", False).alias("l"), "codes_a", "codes_b")
    differ = (F.size("codes_a") > 0) & (F.size("codes_b") > 0) & (F.col("codes_a") != F.col("codes_b"))
    return p.filter((F.col("n") / F.col("s") >= min_overlap) & (F.col("s") / F.col("l") >= min_ratio) & ~differ).select("dropped", "kept", "n")


def best_copies(candidates: DataFrame) -> DataFrame:
    """(dropped, kept): the target with the largest overlap, ties by the smallest id."""
    best = candidates.groupBy("dropped").agg(F.min(F.struct((-F.col("n")).alias("d"), "kept")).alias("m"))
    return best.select("dropped", "m.kept")


def resolve_chains(copies: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(dropped, kept) with every chain followed to the document that stays, by pointer jumping."""
    now = staged(copies.select("dropped", "kept"), "copies")
    for _ in range(max_rounds):
        nxt = now.select(F.col("dropped").alias("kept"), F.col("kept").alias("further"))
        step = staged(now.join(nxt, "kept", "left").select("dropped", F.coalesce("further", "kept").alias("kept"), F.col("further").isNotNull().alias("moved")), "copies")
        moved = step.filter("moved").limit(1).count()
        now = step.select("dropped", "kept")
        if not moved:
            break
    return now


def without_copies(documents: DataFrame, copies: DataFrame) -> DataFrame:
    """Documents that are no copy of another."""
    return documents.join(copies.select(F.col("dropped").alias("doc_id")), "doc_id", "left_anti")

