"""Business terms found in texts by a dictionary of variants.

A dictionary is bounded (``MAX_VARIANTS``); it becomes one alternation, longest variant first, so
each text is read once. Matching is on folded text without markers, on whole words, leftmost and
not overlapping. A variant that ends in ``*`` may go on with letters.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions import patterns as P
from lavra.functions.fold import fold, fold_col

MAX_VARIANTS = 20_000


def term_rules(dictionary: DataFrame) -> list[tuple[str, str]]:
    """(variant, name) of a dictionary (name, variant), longest variant first; a later name of the same variant wins."""
    rows = dictionary.select("name", "variant").limit(MAX_VARIANTS + 1).collect()
    if len(rows) > MAX_VARIANTS:
        raise ValueError(f"a dictionary of more than {MAX_VARIANTS} variants")
    names = {fold(v.strip()): n for n, v in rows if v and v.strip()}
    return [(v, names[v]) for v in sorted(names, key=lambda v: (-len(v), v))]


def _pattern(variant: str) -> str:
    return re.escape(variant.rstrip("*")).replace(r"\ ", r"\s+") + (r"[\p{L}\p{N}_]*" if variant.endswith("*") else "")


def find_terms(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Distinct names with a leading ``#``, sorted; null or no rule gives an empty array."""
    if not rules:
        return F.array().cast("array<string>")
    clean = F.regexp_replace(fold_col(F.coalesce(text, F.lit(""))), fold(P.MARKER).replace(r"\]", r"\]"), " ")
    word = r"[\p{L}\p{N}_]"
    found = F.regexp_extract_all(clean, F.lit(rf"(?<!{word})(?:{'|'.join(_pattern(v) for v, _ in rules)})(?!{word})"), F.lit(0))
    # a match is looked up by its text, and by its beginning where the variant goes on; the first rule of both holds
    tidy = lambda v: re.sub(r"\s+", " ", v.rstrip("*"))
    places = {tidy(v): i for i, (v, _) in reversed(list(enumerate(rules))) if not v.endswith("*")}
    whole = F.from_json(F.lit(json.dumps(places)), "map<string,int>")
    begins = F.from_json(F.lit(json.dumps([{"v": tidy(v), "i": i} for i, (v, _) in enumerate(rules) if v.endswith("*")])), "array<struct<v:string,i:int>>")
    names = F.from_json(F.lit(json.dumps(["#" + n for _, n in rules])), "array<string>")

    def name(match: Column) -> Column:
        first = F.get(F.filter(begins, lambda b: match.startswith(b["v"])), F.lit(0))["i"]
        return F.get(names, F.least(F.try_element_at(whole, match), first))

    return F.array_sort(F.array_distinct(F.filter(F.transform(F.transform(found, lambda m: F.regexp_replace(m, r"\s+", " ")), name), lambda n: n.isNotNull())))
