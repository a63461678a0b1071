"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.email import is_email, newly_written
from lavra.session import table


def _emails(spark, d):
    c = table(spark, d, "chunks_titled")
    return c.filter(is_email(F.col("record_type"))).select(F.col("chunk_id").alias("id"), "text", F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("record").cast("string")).alias("thread"), "position")


def p5_found(spark, d):
    """Lines newly written by the e-mail's sender."""
    return newly_written(_emails(spark, d)).select(F.col("id").alias("chunk_id"), "line_no")


QUERIES = {"p5_found": p5_found}
ORACLES: dict = {}
