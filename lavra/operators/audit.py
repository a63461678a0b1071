"""The audit of a clustering: links between chunks, summaries of clusters and a report in six sections.

Inputs are chunks (as titled), vectors (chunk_id, vec) and clusters (chunk_id, cluster), noise null or
below 0. Neighbours (id, neighbour, similarity) come from an index or from the exact search.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import body, module_of_programs
from lavra.operators import links as L
from lavra.operators import phrases, vectors
from lavra.session import staged
from lavra.sources import sinks


@dataclass
class Audit:
    """The tables of an audit, staged; ``write`` stores the four files and the report."""

    links: DataFrame
    summary: DataFrame
    pairs: DataFrame
    placed: DataFrame
    sections: list[tuple[str, DataFrame]]

    def write(self, out: str) -> str:
        sinks.write_csv(self.links, f"{out}/chunk_links")
        sinks.write_csv(self.summary.orderBy(F.desc("size"), "cluster"), f"{out}/cluster_summary", single=True)
        sinks.write_csv(self.pairs.orderBy(F.desc("links"), "cluster_a", "cluster_b"), f"{out}/cluster_links", single=True)
        sinks.write_csv(self.placed, f"{out}/clusters")
        text = sinks.report(self.sections)
        sinks.write_report(self.links.sparkSession, text, f"{out}/quality_report")
        return text


def audit(chunks: DataFrame, vecs: DataFrame, clusters: DataFrame, neighbours: DataFrame, least: float = 0.55) -> Audit:
    c = chunks.join(clusters.select("chunk_id", "cluster"), "chunk_id", "left").withColumn("module", module_of_programs(F.col("main_programs")))
    c = staged(c.join(vecs.select("chunk_id", "vec"), "chunk_id", "left"), "audit")
    members = c.filter("cluster >= 0 and vec is not null").select("cluster", F.col("chunk_id").alias("id"), "vec")
    label = c.select(F.col("chunk_id").alias("id"), "cluster")
    links = staged(L.typed_links(neighbours, c, least), "links")
    words = staged(phrases.cluster_keywords(c.select(F.col("chunk_id").alias("id"), "cluster", body(F.col("text")).alias("text"))), "keywords")
    pairs = L.strongest_cluster_links(L.cluster_links(links, label), words, None)
    held = L.cohesion(members).select("cluster", "cohesion", "example")
    summary = staged(L.cluster_summary(c).join(words, "cluster", "left").join(held, "cluster", "left"), "summary")
    side = lambda s: c.select(F.col("chunk_id").alias(f"{s}_chunk"), F.col("cluster").alias(f"{s}_cluster"), F.col("title").alias(f"{s}_title"))
    shown = links.select(F.col("a").alias("from_chunk"), F.col("b").alias("to_chunk"), "similarity", "relation", "shared_programs").join(side("from"), "from_chunk").join(side("to"), "to_chunk")
    _, xy = vectors.principal_components(c.select(F.col("chunk_id").alias("id"), "vec"), 2)
    xy = xy.select(F.col("id").alias("chunk_id"), F.get("xy", F.lit(0)).alias("x"), F.get("xy", F.lit(1)).alias("y"))
    placed = c.join(xy, "chunk_id").select("chunk_id", "cluster", "x", "y", "doc_name", "record_type", "module", "title")
    size = c.agg(F.count(F.lit(1)).alias("chunks"), F.countDistinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("clusters"), F.count_if(F.coalesce(F.col("cluster"), F.lit(-1)) < 0).alias("noise"))
    consecutive = L.consecutive_similarity(c.withColumn("vec", vectors.l2_normalize(F.col("vec"))))
    sections = [
        ("chunks, clusters and chunks without one; agreement of clusters and modules", size.crossJoin(L.nmi(c.select(F.col("module").alias("x"), F.col("cluster").alias("y"))))),  # two single rows
        ("links by relation", L.links_by_relation(links).orderBy(F.desc("links"))),
        ("near duplicates", L.near_duplicates(links).select("similarity", "a", "b")),
        ("numbered topics in more than one cluster", L.split_topics(c).select("topic_id", "chunks", F.array_join(F.transform("clusters", lambda x: x.cast("string")), " ")).orderBy("topic_id")),
        ("consecutive chunks of a record that are very unlike or very alike", consecutive.groupBy("side").agg(F.count(F.lit(1)).alias("pairs")).orderBy("side")),
        ("clusters grouped by form", L.form_clusters(summary).orderBy(F.desc("size"), "cluster")),
    ]
    cols = ["cluster", "size", F.array_join(F.coalesce("keywords", F.array().cast("array<string>")), ", ").alias("keywords"), "top_module", "module_purity", "modules", "record_types", "documents", "largest_doc_share", "cohesion", "example"]
    return Audit(shown, summary.select(*cols), pairs, placed, sections)
