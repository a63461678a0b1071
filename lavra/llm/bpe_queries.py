"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.bpe import decode, encode
from lavra.session import table


def p7_ids(spark, d):
    """Token ids of every document."""
    return encode(table(spark, d, "documents").select("doc_id", "text"))


def p7_decoded(spark, d):
    """Every document's text back from its ids."""
    return decode(p7_ids(spark, d)).select("doc_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("md5"))


QUERIES = {"p7_ids": p7_ids, "p7_decoded": p7_decoded}
ORACLES = {"p7_decoded": "SELECT doc_id, length(coalesce(text, '')) AS n, md5(coalesce(text, '')) AS md5 FROM documents"}
