"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.checks import P8
from lavra.llm.leakage import MATCH, leaked_passages
from lavra.session import table


def _passages(spark, d):
    return leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark, d):
    """Documents that hold 12 consecutive words of one item and no other."""
    aligned = _passages(spark, d).filter(F.col("points") >= 12 * MATCH)  # the exact check follows
    return aligned.filter("longest >= 12").select("doc_id", "item_id").distinct()


def p8_aligned(spark, d):
    """Every passage aligned with an item over a tenth of its words or more, edited copies included."""
    return _passages(spark, d).filter("score >= 0.1").withColumn("score", F.round("score", 6)).drop("points")


QUERIES = {"p8_found": p8_found, "p8_aligned": p8_aligned}
ORACLES = {"p8_found": P8}
