"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.checks import P3
from lavra.llm.density import density_clusters, describe_clusters, isolated_clusters
from lavra.llm.neighbours import valid_vectors
from lavra.session import staged, table

LEAST = 0.58


def vectors_of(spark, d):
    v = table(spark, d, "chunk_vectors").select(F.col("chunk_id").alias("id"), F.col("vectors").alias("vector"))
    return valid_vectors(v, table(spark, d, "chunks_titled").select(F.col("chunk_id").alias("id")))


def p3_found(spark, d):
    """Members of the clusters of 15 or more vectors of which every two reach a cosine of 0.58, and none with a vector outside."""
    return members_of(vectors_of(spark, d)).withColumnRenamed("id", "chunk_id")


def members_of(numbered):
    """(id, cluster_key) of vectors (num, id, vec): clusters selected by stability, joined where they are linked, and checked."""
    chosen, _ = density_clusters(numbered, LEAST, epsilon=0.0)
    # joined by shuffle at every size: both sides grow with the data; the exact check of every set follows
    placed = staged(numbered.join(chosen.hint("shuffle_merge"), "num", "left").select("num", F.coalesce("cluster", "num").alias("cluster"), "vec"), "p3-placed")
    m = staged(isolated_clusters(placed, LEAST).join(numbered.select("num", "id"), "num"), "p3-found")
    key = m.groupBy("cluster").agg(F.min("id").alias("cluster_key"))
    return m.join(key, "cluster").select("id", "cluster_key")


def p3_clusters(spark, d):
    """Each cluster's size and its most typical members."""
    return typical_of(vectors_of(spark, d))


def typical_of(numbered):
    """(cluster_key, size, exemplars) of vectors (num, id, vec); any split may count, by stability."""
    return describe_clusters(*density_clusters(numbered, LEAST, epsilon=0.0))


QUERIES = {"p3_found": p3_found, "p3_clusters": p3_clusters}
ORACLES = {"p3_found": P3}
