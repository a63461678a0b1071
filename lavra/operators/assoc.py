"""Association rules between the items of baskets, as plain DataFrame aggregation.

An *occurrence* table has one row per (basket, doc, item); ``item`` is null for a basket without
items. Baskets are counted even when empty. Items named ``#...`` are terms, items with a hyphen
are messages, all others are programs.

Null baskets or documents form a group of their own; repeated rows count once; an empty input
gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def kind_of(item: Column) -> Column:
    """term, message or program, by the shape of the name."""
    return F.when(item.startswith("#"), "term").when(item.contains("-"), "message").otherwise("program")


def module_of_item(item: Column) -> Column:
    """``#`` for terms, the part before the hyphen for messages, the leading capitals for programs."""
    return (
        F.when(item.startswith("#"), F.lit("#"))
        .when(item.contains("-"), F.substring_index(item, "-", 1))
        .otherwise(F.regexp_extract(item, "^[A-Z]+", 0))
    )


def basket_key(unit: str, prefix: str = "") -> Column:
    """Basket of a chunk row for the unit chunk, topic (numbered, else record), record or document."""
    c = lambda n: F.col(prefix + n)
    record = F.concat(F.coalesce(c("doc_id").cast("string"), F.lit("")), F.lit("-r"), F.coalesce(c("record").cast("string"), F.lit("")))
    if unit == "chunk":
        return c("chunk_id")
    if unit == "document":
        return c("doc_id").cast("string")
    if unit == "topic":
        return F.when((F.coalesce(c("topic_number"), F.lit("")) != "") & c("topic_id").isNotNull(), c("topic_id")).otherwise(record)
    if unit == "record":
        return record
    raise ValueError(f"unknown basket unit {unit!r}")


def split_codes(column: Column) -> Column:
    """Array of the blank-separated tokens; null and empty give an empty array."""
    return F.filter(F.split(F.coalesce(column, F.lit("")), r"\s+"), lambda x: x != "")


def chunk_items(messages: bool = False, terms: Column | None = None) -> Column:
    """Distinct items of a chunk row: both program columns, optionally messages and terms."""
    items = F.array_union(split_codes(F.col("mentioned_programs")), split_codes(F.col("main_programs")))
    if messages:
        found = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(r"\b((?:KND|ORA)-\s?\d+)"), 1)
        both = F.array_union(F.coalesce(F.col("messages"), F.array().cast("array<string>")), found)
        items = F.array_union(items, F.transform(both, lambda m: F.regexp_replace(m, r"\s", "")))
    if terms is not None:
        items = F.array_union(items, terms)
    return F.array_sort(F.array_distinct(items))


def drop_copied_chunks(chunks: DataFrame, items: str = "items", order=("doc_id", "position")) -> DataFrame:
    """First row wins among chunks of two or more items with equal items and text start.

    The first of each fingerprint is found by an aggregation of ids, so a text that fills a third of
    all rows makes no hot group; the chunks are then kept by id. Rows with fewer than two items
    always stay; rows that repeat a chunk id stay or go together.
    """
    squeezed = F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}\p{N}_]+", "")
    fp = F.sha2(F.concat_ws("\u0001", F.concat_ws(" ", F.col(items)), F.substring(squeezed, 1, 150)), 256)
    multi = chunks.filter(F.size(items) >= 2).select(fp.alias("fp"), F.struct(*order, "chunk_id").alias("o"))
    first = multi.groupBy("fp").agg(F.min("o").alias("o")).select("o.chunk_id")
    return chunks.filter(F.size(items) < 2).unionByName(chunks.filter(F.size(items) >= 2).join(first, "chunk_id", "left_semi").select(*chunks.columns))


def build_baskets(occurrences: DataFrame, max_items: int | None = 25) -> DataFrame:
    """(basket, doc, items): distinct sorted items; baskets with more than ``max_items`` non-terms left out."""
    b = occurrences.groupBy("basket", "doc").agg(F.array_sort(F.collect_set("item")).alias("items"))
    if max_items is not None:
        b = b.filter(F.size(F.filter("items", lambda i: ~i.startswith("#"))) <= max_items)
    return b


def totals(baskets: DataFrame) -> DataFrame:
    """One row: number of baskets (those without items included) and of distinct documents."""
    return baskets.agg(F.count(F.lit(1)).alias("n_baskets"), F.countDistinct("doc").alias("n_docs"))


def item_counts(baskets: DataFrame) -> DataFrame:
    """(item, baskets, documents)."""
    long = baskets.select("doc", F.explode("items").alias("item"))
    return _counted(long, ["item"]).select("item", F.col("n").alias("baskets"), "documents")


def _counted(long: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and distinct documents per key, pre-aggregated per document so that no key is hot."""
    per_doc = long.groupBy(*keys, "doc").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("doc").alias("documents"))


def pair_column(items: str = "items") -> Column:
    """All unordered pairs of a sorted array, made in the row, so no self-join is needed."""
    return F.expr(
        f"flatten(transform({items}, (a, i) -> transform(slice({items}, i + 2, greatest(size({items}) - i - 1, 0)),"
        " b -> named_struct('a', a, 'b', b))))"
    )


def pair_counts(baskets: DataFrame) -> DataFrame:
    """(a, b, together, documents) with a < b."""
    long = baskets.filter(F.size("items") >= 2).select("doc", F.explode(pair_column()).alias("p")).select("doc", "p.a", "p.b")
    return _counted(long, ["a", "b"]).select("a", "b", F.col("n").alias("together"), "documents")


def rules(
    baskets: DataFrame,
    min_together: int = 3,
    min_docs: int = 3,
    min_confidence: float = 0.2,
    min_lift: float = 2.0,
    term_confidence: float = 0.03,
    term_lift: float = 3.0,
    term_term: bool = False,
) -> DataFrame:
    """Directed rules x -> y with confidence, lift, conviction (null where infinite), kind, weight.

    Support is filtered before the counts are joined; thresholds compare unrounded values.
    """
    counts, n = item_counts(baskets), totals(baskets)
    pairs = pair_counts(baskets).filter((F.col("together") >= min_together) & (F.col("documents") >= min_docs))
    if not term_term:
        pairs = pairs.filter(~(F.col("a").startswith("#") & F.col("b").startswith("#")))
    ends = [F.struct(F.col(x).alias("from_item"), F.col(y).alias("to_item")) for x, y in (("a", "b"), ("b", "a"))]
    both = pairs.withColumn("e", F.explode(F.array(*ends))).select("e.*", "together", "documents")
    both = both.join(counts.select(F.col("item").alias("from_item"), F.col("baskets").alias("from_baskets")), "from_item")
    both = both.join(counts.select(F.col("item").alias("to_item"), F.col("baskets").alias("to_baskets")), "to_item")
    both = both.crossJoin(F.broadcast(n.select("n_baskets")))  # one row
    conf = F.col("together") / F.col("from_baskets")
    py = F.col("to_baskets") / F.col("n_baskets")
    r = both.withColumn("confidence", conf).withColumn("lift", conf / py)
    r = r.withColumn("conviction", F.when(F.col("together") < F.col("from_baskets"), (1 - py) / (1 - F.col("confidence"))))
    from_term = F.col("from_item").startswith("#") & ~F.col("to_item").startswith("#")
    keep = F.when(from_term, (F.col("confidence") >= term_confidence) & (F.col("lift") >= term_lift)).otherwise(
        (F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift)
    )
    mx, my = module_of_item(F.col("from_item")), module_of_item(F.col("to_item"))
    return r.filter(keep).select(
        "from_item", "to_item", "together", "documents", "from_baskets", "to_baskets", "confidence", "lift", "conviction",
        F.concat(kind_of(F.col("from_item")), F.lit("->"), kind_of(F.col("to_item"))).alias("kind"),
        ((mx != my) & (mx != "#") & (my != "#")).cast("int").alias("cross_module"),
    )


def with_score(r: DataFrame) -> DataFrame:
    """Ranking score (from the lift rounded to two decimals, capped at 50) and walk weight."""
    shrunk = F.col("together") / (F.col("from_baskets") + 3)
    boost = F.log2(1 + F.least(F.round("lift", 2), F.lit(50.0)))
    return r.withColumn("score", F.round(shrunk * boost * F.log2(1 + F.col("documents")), 3)).withColumn("weight", F.round(shrunk, 4))


def item_report(baskets: DataFrame, r: DataFrame) -> DataFrame:
    """Each item with module, baskets, documents and the number of rules that start at it."""
    n = r.groupBy(F.col("from_item").alias("item")).agg(F.count(F.lit(1)).alias("rules_from"))
    return item_counts(baskets).join(n, "item", "left").select(
        "item", module_of_item(F.col("item")).alias("module"), "baskets", "documents", F.coalesce("rules_from", F.lit(0)).alias("rules_from")
    )


def run_report(baskets: DataFrame, r: DataFrame) -> DataFrame:
    """One row of run figures: baskets, baskets of several items, their mean size, items, covered items, rules."""
    multi = F.size("items") >= 2
    b = baskets.agg(
        F.count(F.lit(1)).alias("baskets"), F.countDistinct("doc").alias("documents"), F.count_if(multi).alias("multi_baskets"),
        F.avg(F.when(multi, F.size("items"))).alias("avg_items"),
    )
    i = item_counts(baskets).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("baskets") >= 5).alias("items_in_5"))
    q = r.agg(F.count(F.lit(1)).alias("rules"), F.countDistinct("from_item").alias("covered"), F.coalesce(F.sum("cross_module"), F.lit(0)).alias("cross_rules"))
    return b.crossJoin(i).crossJoin(q)  # three single rows


def evidence(chunks: DataFrame, r: DataFrame, max_baskets: int = 30, limit: int = 3) -> DataFrame:
    """Example chunks of every rule pair: (a, b, rank, chunk_id).

    ``chunks`` has chunk_id, basket, doc, seq (a total order) and items. Of the first
    ``max_baskets`` baskets of a pair, one chunk per document: one with both items if the basket
    has it, otherwise the basket's first chunk.
    """
    wanted = r.select(F.least("from_item", "to_item").alias("a"), F.greatest("from_item", "to_item").alias("b")).distinct()
    per_basket = chunks.groupBy("basket", "doc").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.min("seq").alias("bseq"), F.min_by("chunk_id", "seq").alias("first_chunk"),
    )
    pairs = per_basket.select("basket", "doc", "bseq", "first_chunk", F.explode(pair_column()).alias("p")).select("*", "p.a", "p.b").drop("p")
    pairs = pairs.join(wanted, ["a", "b"], "left_semi")
    first = W.partitionBy("a", "b").orderBy("bseq", "basket")
    # a frequent pair's first baskets are found in parts, so that no task sees all of them
    part = W.partitionBy("a", "b", "part").orderBy("bseq", "basket")
    pairs = pairs.withColumn("part", F.pmod(F.xxhash64("basket"), F.lit(64))).withColumn("n", F.row_number().over(part)).filter(F.col("n") <= max_baskets).drop("part", "n")
    pairs = pairs.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= max_baskets)
    both = chunks.select("basket", "seq", "chunk_id", F.explode(pair_column()).alias("p")).select("basket", "p.a", "p.b", "seq", "chunk_id")
    best = both.join(pairs.select("basket", "a", "b"), ["basket", "a", "b"], "left_semi").groupBy("basket", "a", "b").agg(F.min_by("chunk_id", "seq").alias("both_chunk"))
    one = pairs.join(best, ["basket", "a", "b"], "left").withColumn("chunk_id", F.coalesce("both_chunk", "first_chunk"))
    one = one.withColumn("d", F.row_number().over(W.partitionBy("a", "b", "doc").orderBy("n"))).filter("d = 1")
    return one.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= limit).select("a", "b", "rank", "chunk_id")


def related_terms(r: DataFrame, k: int = 6) -> DataFrame:
    """Terms most tied to each program: (item, related_terms), strongest first."""
    s = F.col("confidence") * F.log2(1 + F.least(F.round("lift", 2), F.lit(50.0)))
    t = r.filter(F.col("kind") == "program->term").withColumn("s", s)
    t = t.withColumn("n", F.row_number().over(W.partitionBy("from_item").orderBy(F.desc("s"), "to_item"))).filter(F.col("n") <= k)
    return t.groupBy(F.col("from_item").alias("item")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "to_item"))), lambda x: F.substring(x["to_item"], 2, 1000)), ", ").alias("related_terms")
    )
