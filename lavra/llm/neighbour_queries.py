"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.checks import P6
from lavra.llm.density_queries import vectors_of
from lavra.llm.neighbours import mutual_pairs, nearest_vectors


def p6_found(spark, d):
    """Pairs of a cosine of 0.95 or more that are among each other's 5 most similar."""
    pairs = mutual_pairs(nearest_vectors(vectors_of(spark, d)), 0.95)
    return pairs.select(F.col("a").alias("chunk_a"), F.col("b").alias("chunk_b"))


def p6_neighbours(spark, d):
    """The 5 most similar vectors of every vector."""
    return nearest_vectors(vectors_of(spark, d)).withColumnRenamed("id", "chunk_id")


QUERIES = {"p6_found": p6_found, "p6_neighbours": p6_neighbours}
ORACLES = {"p6_found": P6}
