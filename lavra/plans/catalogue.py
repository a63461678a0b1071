"""Every core query by name, and the SQL that checks it."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict = {}

for _module in ("assoc_queries", "text_queries", "graph_queries", "vector_queries", "phrase_queries", "menu_queries", "io_queries"):
    _m = importlib.import_module(f"lavra.plans.{_module}")
    QUERIES |= getattr(_m, "QUERIES", {})
    ORACLES |= _m.ORACLES
