"""Queries of problem 9."""

from __future__ import annotations

from lavra.llm.quality import text_quality
from lavra.session import table


def p9_found(spark, d):
    """Documents that are lists, tables or junk."""
    return text_quality(table(spark, d, "documents")).filter("kind in ('list', 'table', 'junk')").select("doc_id", "kind")


def p9_statistics(spark, d):
    """Every document's statistics and kind."""
    return text_quality(table(spark, d, "documents"))


QUERIES = {"p9_found": p9_found, "p9_statistics": p9_statistics}
ORACLES: dict = {}
