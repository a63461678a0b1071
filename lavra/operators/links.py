"""Links between similar chunks, cluster summaries and the audit of a chunking.

Links are (a, b, similarity); chunks carry doc_id, record, topic_id and a cluster, null or -1 for
noise. Empty inputs give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.operators.assoc import split_codes
from lavra.operators.vectors import dot, norm


def relation(a: str = "a_", b: str = "b_") -> Column:
    """other_document, same_topic, same_record or same_document, in this order."""
    c = lambda n: (F.col(a + n), F.col(b + n))
    (da, db), (ta, tb), (ra, rb) = c("doc_id"), c("topic_id"), c("record")
    return (
        F.when(~da.eqNullSafe(db), "other_document").when((F.coalesce(ta, F.lit("")) != "") & (ta == tb), "same_topic").when(ra.eqNullSafe(rb), "same_record").otherwise("same_document")
    )


def typed_links(found: DataFrame, chunks: DataFrame, least: float = 0.55) -> DataFrame:
    """(a, b, similarity, relation, shared_programs) of neighbours (id, neighbour, similarity) at or above ``least``."""
    programs = F.array_union(split_codes(F.col("mentioned_programs")), split_codes(F.col("main_programs")))
    c = chunks.select("chunk_id", "doc_id", "record", "topic_id", programs.alias("programs"))
    side = lambda s: c.select(*[F.col(x).alias(f"{s}_{x}") for x in c.columns])
    j = found.filter(F.col("similarity") >= least).join(side("a"), F.col("id") == F.col("a_chunk_id")).join(side("b"), F.col("neighbour") == F.col("b_chunk_id"))
    shared = F.array_join(F.array_sort(F.array_intersect("a_programs", "b_programs")), " ")
    return j.select(F.col("id").alias("a"), F.col("neighbour").alias("b"), "similarity", relation().alias("relation"), shared.alias("shared_programs"))


def links_by_relation(links: DataFrame) -> DataFrame:
    return links.groupBy("relation").agg(F.count(F.lit(1)).alias("links"))


def near_duplicates(links: DataFrame, least: float = 0.97, first: int = 25) -> DataFrame:
    """Directed links from the smaller to the larger id at or above ``least``, the most similar ``first``."""
    return links.filter((F.col("similarity") >= least) & (F.col("a") < F.col("b"))).orderBy(F.desc("similarity"), "a", "b").limit(first)


def cluster_links(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(cluster_a, cluster_b, links) between different clusters; ``labels`` is (id, cluster), noise left out."""
    lab = labels.filter("cluster is not null and cluster >= 0")
    j = links.join(lab.select(F.col("id").alias("a"), F.col("cluster").alias("ca")), "a").join(lab.select(F.col("id").alias("b"), F.col("cluster").alias("cb")), "b")
    j = j.filter("ca <> cb").select(F.least("ca", "cb").alias("cluster_a"), F.greatest("ca", "cb").alias("cluster_b"))
    return j.groupBy("cluster_a", "cluster_b").agg(F.count(F.lit(1)).alias("links"))


def centroids(vectors: DataFrame) -> DataFrame:
    """(cluster, centre): unit mean vectors of (id, cluster, vec), pre-aggregated by place."""
    m = vectors.select("cluster", F.posexplode("vec").alias("pos", "x")).groupBy("cluster", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    c = m.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("c"))
    return c.select("cluster", F.transform(F.array(F.struct("c", (norm(F.col("c")) + 1e-9).alias("n"))), lambda s: F.transform(s["c"], lambda x: x / s["n"]))[0].alias("centre"))


def cohesion(vectors: DataFrame) -> DataFrame:
    """(cluster, size, cohesion, example): mean dot with the centre, and the member nearest to it (ties by id)."""
    s = vectors.join(centroids(vectors), "cluster").select("cluster", "id", dot(F.col("vec"), F.col("centre")).alias("s"))
    return s.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.avg("s").alias("cohesion"), F.min(F.struct((-F.round("s", 9)).alias("d"), "id")).alias("m")).select("cluster", "size", "cohesion", F.col("m.id").alias("example"))


def _shares(t: DataFrame, column: str, most: int | None = None) -> DataFrame:
    """(cluster, text "value:n value:n ...") by frequency, ties by value; null values are left out."""
    n = t.filter(F.col(column).isNotNull()).groupBy("cluster", column).agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("r", F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("n"), column)))
    n = n if most is None else n.filter(F.col("r") <= most)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("r", F.concat(F.col(column).cast("string"), F.lit(":"), F.col("n").cast("string")).alias("t")))), lambda x: x["t"])
    return n.groupBy("cluster").agg(F.array_join(listed, " ").alias(column + "s"), F.max("n").alias("top_n"), F.sum("n").alias("all_n"), F.min_by(column, "r").alias("top_" + column))


def cluster_summary(chunks: DataFrame) -> DataFrame:
    """Size, top module and its share, four modules, record types, documents and the largest one's share per cluster.

    ``chunks`` is (chunk_id, cluster, module, record_type, doc_id); an empty module is unlabelled.
    """
    c = chunks.filter("cluster is not null and cluster >= 0").withColumn("module", F.nullif("module", F.lit("")))
    size = c.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    mods, top = _shares(c, "module", 4), _shares(c, "module")
    types = _shares(c, "record_type").select("cluster", "record_types", F.col("top_record_type"), F.col("top_n").alias("type_n"))
    docs = c.groupBy("cluster", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(F.count(F.lit(1)).alias("documents"), F.max("n").alias("largest"))
    j = size.join(mods.select("cluster", "modules"), "cluster", "left").join(top.select("cluster", "top_module", (F.col("top_n") / F.col("all_n")).alias("module_purity")), "cluster", "left")
    j = j.join(types, "cluster", "left").join(docs, "cluster")
    return j.select("cluster", "size", F.coalesce("top_module", F.lit("")).alias("top_module"), "module_purity", F.coalesce("modules", F.lit("")).alias("modules"), F.coalesce("record_types", F.lit("")).alias("record_types"),
                    "documents", (F.col("largest") / F.col("size")).alias("largest_doc_share"), "top_record_type", (F.col("type_n") / F.col("size")).alias("top_type_share"))


def form_clusters(summary: DataFrame, share: float = 0.8) -> DataFrame:
    """Clusters that group by form: mostly one document, else mostly e-mails."""
    one = F.col("largest_doc_share") >= share
    mail = (F.col("top_record_type") == "email") & (F.col("top_type_share") >= share)
    return summary.filter(one | mail).select("cluster", "size", F.when(one, "one_document").otherwise("email").alias("form"))


def nmi(labels: DataFrame) -> DataFrame:
    """(nmi): normalised mutual information of (x, y), with the mean of the entropies; one row.

    Null labels, empty x and noise (y below 0) are left out. One value on both sides gives 1, on
    one side 0; without rows it is null.
    """
    t = labels.filter("x is not null and y is not null and cast(x as string) <> '' and y >= 0")
    n = t.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    px, py = n.groupBy("x").agg(F.sum("n").alias("nx")), n.groupBy("y").agg(F.sum("n").alias("ny"))
    j = n.join(px, "x").join(py, "y").crossJoin(F.broadcast(total))
    mi = j.agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))).alias("mi"))
    ent = lambda d, c, o: d.crossJoin(F.broadcast(total)).agg((-F.sum(F.col(c) / F.col("t") * F.log(F.col(c) / F.col("t")))).alias(o))
    all_ = mi.crossJoin(ent(px, "nx", "hx")).crossJoin(ent(py, "ny", "hy"))  # three single rows
    mean = (F.col("hx") + F.col("hy")) / 2
    return all_.select(F.when(F.col("mi").isNull(), None).when(mean == 0, 1.0).when((F.col("hx") == 0) | (F.col("hy") == 0), 0.0).otherwise(F.greatest(F.col("mi") / mean, F.lit(0.0))).alias("nmi"))


def split_topics(chunks: DataFrame) -> DataFrame:
    """(topic_id, chunks, clusters) of numbered topics whose chunks lie in more than one cluster."""
    c = chunks.filter("coalesce(topic_number, '') <> '' and topic_id is not null")
    g = c.groupBy("topic_id").agg(F.count(F.lit(1)).alias("chunks"), F.array_sort(F.collect_set(F.when(F.col("cluster") >= 0, F.col("cluster")))).alias("clusters"))
    return g.filter((F.col("chunks") > 1) & (F.size("clusters") > 1))


def consecutive_similarity(chunks: DataFrame, low: float = 0.25, high: float = 0.92, span: int = 10_000) -> DataFrame:
    """(chunk_id, next_id, similarity, side) of neighbours in a record that are very unlike or very alike.

    ``chunks`` is (chunk_id, doc_id, record, position, vec). Order is within the document. A document
    may hold a large part of all rows: its order is found in ranges of ``span`` positions, over ids
    only, each range ends at the first chunk of the next one, and vectors are joined to the pairs.
    """
    place = chunks.select("chunk_id", "doc_id", "record", "position", F.floor(F.coalesce("position", F.lit(-1)) / span).alias("span"))
    inside = W.partitionBy("doc_id", "span").orderBy("position", "chunk_id")
    following = F.struct("chunk_id", "record")
    c = place.withColumn("next", F.lead(following).over(inside))
    first = place.groupBy("doc_id", "span").agg(F.min(F.struct("position", "chunk_id", "record")).alias("f"))
    # one row a range: few even for a document with a third of all chunks
    after = first.withColumn("g", F.lead("f").over(W.partitionBy("doc_id").orderBy("span"))).select(F.col("doc_id").alias("d"), F.col("span").alias("s"), F.struct("g.chunk_id", "g.record").alias("g"))
    c = c.join(after, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("span") == F.col("s")), "left").withColumn("next", F.coalesce("next", "g"))
    c = c.filter(F.col("record").eqNullSafe(F.col("next.record")) & F.col("next.chunk_id").isNotNull()).select("chunk_id", F.col("next.chunk_id").alias("next_id"))
    v = chunks.filter("vec is not null").select("chunk_id", "vec")
    c = c.join(v, "chunk_id").join(v.select(F.col("chunk_id").alias("next_id"), F.col("vec").alias("next_vec")), "next_id")
    s = c.select("chunk_id", "next_id", dot(F.col("vec"), F.col("next_vec")).alias("similarity"))
    return s.filter((F.col("similarity") < low) | (F.col("similarity") > high)).withColumn("side", F.when(F.col("similarity") < low, "low").otherwise("high"))


def strongest_cluster_links(pairs: DataFrame, keywords: DataFrame, first: int | None = 20) -> DataFrame:
    """The ``first`` strongest pairs of clusters, or all, with three keywords of each."""
    k = keywords.select("cluster", F.array_join(F.slice("keywords", 1, 3), ", ").alias("k"))
    top = pairs if first is None else pairs.orderBy(F.desc("links"), "cluster_a", "cluster_b").limit(first)
    top = top.join(k.select(F.col("cluster").alias("cluster_a"), F.col("k").alias("keywords_a")), "cluster_a", "left")
    return top.join(k.select(F.col("cluster").alias("cluster_b"), F.col("k").alias("keywords_b")), "cluster_b", "left").select("cluster_a", "cluster_b", "links", "keywords_a", "keywords_b")


def matching_points(chunks: DataFrame, query: str) -> DataFrame:
    """Chunks whose title, document, module or id contain the query, whatever its case; blank matches all."""
    return chunks.filter(F.lower(F.concat_ws(" ", "title", "doc_name", "module", "chunk_id")).contains(query.strip().lower()))


def linked_clusters(pairs: DataFrame, cluster: int, first: int = 10) -> DataFrame:
    """The clusters with most links to one cluster."""
    p = pairs.filter((F.col("cluster_a") == cluster) | (F.col("cluster_b") == cluster))
    other = F.when(F.col("cluster_a") == cluster, F.col("cluster_b")).otherwise(F.col("cluster_a"))
    return p.select(other.alias("cluster"), "links").orderBy(F.desc("links"), "cluster").limit(first)


def cluster_members(chunks: DataFrame, cluster: int, first: int = 200) -> DataFrame:
    """The first members of a cluster in document order."""
    return chunks.filter(F.col("cluster") == cluster).orderBy("doc_id", "position", "chunk_id").limit(first)


def keyword_hits(chunks: DataFrame, query: str, record_type: str | None = None) -> DataFrame:
    """(doc_id, doc_name, hits, chunks): chunks of each document whose text or title contains the query."""
    q = query.strip().lower()
    hit = F.lower(F.concat_ws(" ", "title", "text")).contains(q)
    c = chunks if record_type is None else chunks.filter(F.col("record_type") == record_type)
    g = c.groupBy("doc_id", "doc_name").agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("chunks"))
    return g.filter("hits > 0")
