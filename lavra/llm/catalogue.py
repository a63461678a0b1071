"""Every query of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict = {}

for _module in (
    "distinctive_queries", "cooccur_queries", "density_queries", "splitting_queries", "email_queries",
    "neighbour_queries", "bpe_queries", "leakage_queries", "quality_queries",
):
    try:
        _m = importlib.import_module(f"lavra.llm.{_module}")
    except ModuleNotFoundError as missing:
        if not str(missing.name).startswith("lavra.llm."):
            raise
        continue
    QUERIES |= _m.QUERIES
    ORACLES |= _m.ORACLES
