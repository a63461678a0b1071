"""Queries of problem 4."""

from __future__ import annotations

from lavra.llm.checks import P4
from lavra.llm.splitting import split_topics
from lavra.session import table


def p4_found(spark, d):
    """Pieces of every topic above 2,400 characters, taken from the left."""
    return split_topics(table(spark, d, "chunks_titled"))


def p4_bisected(spark, d):
    """Pieces of the same topics by recursive bisection."""
    return split_topics(table(spark, d, "chunks_titled"), method="bisect")


QUERIES = {"p4_found": p4_found, "p4_bisected": p4_bisected}
ORACLES = {"p4_found": P4}
