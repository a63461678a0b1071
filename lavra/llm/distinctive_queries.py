"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.checks import P1
from lavra.llm.distinctive import distinctive_phrases
from lavra.session import table


def _records(spark, d):
    return table(spark, d, "chunks_titled").select(F.col("chunk_id").alias("id"), "text", F.col("key_phrases").alias("phrases"))


def p1_found(spark, d):
    """Own phrases that occur twice or more in their chunk and in 2 to 12 chunks' texts."""
    s = distinctive_phrases(_records(spark, d))
    # the model leaves no weight to phrases found nowhere else; the exact check of the stated counts follows
    return s.filter(F.col("weight") > 0).filter((F.col("tf") >= 2) & (F.col("df") <= 12)).select(F.col("id").alias("chunk_id"), "phrase")


def p1_ranked(spark, d):
    """Every own phrase found in its chunk, with its converged weight and rank."""
    s = distinctive_phrases(_records(spark, d))
    return s.select(F.col("id").alias("chunk_id"), "phrase", "tf", "df", F.round("weight", 9).alias("weight"), "rank")


QUERIES = {"p1_found": p1_found, "p1_ranked": p1_ranked}
ORACLES = {"p1_found": P1}
