"""Association-rule queries over order baskets and over chunk baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators import assoc
from lavra.session import table

LOOSE = {"min_confidence": 0.02, "min_lift": 1.02}


def _brand_occurrences(spark, d, unit="record"):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(part, li.l_partkey == part.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    basket = F.col("l_orderkey") if unit == "record" else F.col("o_custkey")
    return j.select(basket.alias("basket"), F.col("o_custkey").alias("doc"), F.col("p_brand").alias("item"))


_BRAND = """
occ AS (SELECT DISTINCT {basket} AS basket, o_custkey AS doc, p_brand AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
big AS (SELECT basket FROM occ GROUP BY basket HAVING count(*) > {max_items}),
o AS (SELECT * FROM occ WHERE basket NOT IN (SELECT basket FROM big)),
n AS (SELECT count(DISTINCT basket) AS n FROM o),
ic AS (SELECT item, count(*) AS c, count(DISTINCT doc) AS d FROM o GROUP BY item),
pc AS (SELECT x.item AS a, y.item AS b, count(*) AS together, count(DISTINCT x.doc) AS documents
       FROM o x JOIN o y ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2),
dir AS (SELECT a AS f, b AS t, together, documents FROM pc UNION ALL SELECT b, a, together, documents FROM pc),
m AS (SELECT f AS from_item, t AS to_item, together, documents, x.c AS from_baskets, y.c AS to_baskets,
        together / x.c AS confidence, (together / x.c) / (y.c / n.n) AS lift,
        CASE WHEN together < x.c THEN (1 - y.c / n.n) / (1 - together / x.c) END AS conviction
      FROM dir JOIN ic x ON x.item = f JOIN ic y ON y.item = t CROSS JOIN n WHERE together >= 3 AND documents >= 3),
r AS (SELECT * FROM m WHERE confidence >= 0.02 AND lift >= 1.02)
"""
_ROUNDED = ["confidence", "lift", "conviction"]
_RULE_SQL = "from_item, to_item, together, documents, from_baskets, to_baskets, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(conviction, 6) AS conviction"


def _sql(body: str, basket: str = "l_orderkey", max_items: int = 25) -> str:
    return "WITH " + _BRAND.format(basket=basket, max_items=max_items).strip() + "\n" + body


def _rounded(r):
    return r.withColumns({c: F.round(c, 6) for c in _ROUNDED})


def _rule_cols(r):
    return _rounded(r).select("from_item", "to_item", "together", "documents", "from_baskets", "to_baskets", *_ROUNDED)


def _baskets(spark, d, unit="record", max_items=25):
    return assoc.build_baskets(_brand_occurrences(spark, d, unit), max_items)


def assoc_rules_brand(spark, d):
    return _rule_cols(assoc.rules(_baskets(spark, d), **LOOSE))


def assoc_unit_document(spark, d):
    return _rule_cols(assoc.rules(_baskets(spark, d, "document"), **LOOSE))


def assoc_oversized_filter(spark, d):
    return _rule_cols(assoc.rules(_baskets(spark, d, max_items=5), **LOOSE))


def assoc_items(spark, d):
    b = _baskets(spark, d)
    return assoc.item_report(b, assoc.rules(b, **LOOSE)).drop("module")


def assoc_score_topk(spark, d):
    r = assoc.with_score(assoc.rules(_baskets(spark, d), **LOOSE))
    return r.orderBy(F.desc("score"), "from_item", "to_item").limit(20).select("from_item", "to_item", "score", "weight")


def assoc_run_report(spark, d):
    b = _baskets(spark, d)
    return assoc.run_report(b, assoc.rules(b, **LOOSE)).withColumn("avg_items", F.round("avg_items", 6)).drop("cross_rules")


QUERIES = {
    "assoc_rules_brand": assoc_rules_brand, "assoc_unit_document": assoc_unit_document, "assoc_oversized_filter": assoc_oversized_filter,
    "assoc_items": assoc_items, "assoc_score_topk": assoc_score_topk, "assoc_run_report": assoc_run_report,
}
ORACLES = {
    "assoc_rules_brand": _sql(f"SELECT {_RULE_SQL} FROM r"),
    "assoc_unit_document": _sql(f"SELECT {_RULE_SQL} FROM r", basket="o_custkey"),
    "assoc_oversized_filter": _sql(f"SELECT {_RULE_SQL} FROM r", max_items=5),
    "assoc_items": _sql("SELECT item, c AS baskets, d AS documents, (SELECT count(*) FROM r WHERE from_item = item) AS rules_from FROM ic"),
    "assoc_score_topk": _sql(
        "SELECT from_item, to_item, round(together / (from_baskets + 3) * log2(1 + least(round(lift, 2), 50)) * log2(1 + documents), 3) AS score,"
        " round(together / (from_baskets + 3), 4) AS weight FROM r ORDER BY score DESC, from_item, to_item LIMIT 20"
    ),
    "assoc_run_report": _sql(
        "SELECT n.n AS baskets, (SELECT count(DISTINCT doc) FROM o) AS documents,"
        " (SELECT count(*) FROM (SELECT basket FROM o GROUP BY basket HAVING count(*) >= 2)) AS multi_baskets,"
        " (SELECT round(avg(c), 6) FROM (SELECT count(*) AS c FROM o GROUP BY basket HAVING count(*) >= 2)) AS avg_items,"
        " (SELECT count(*) FROM ic) AS items, (SELECT count(*) FROM ic WHERE c >= 5) AS items_in_5,"
        " (SELECT count(*) FROM r) AS rules, (SELECT count(DISTINCT from_item) FROM r) AS covered FROM n"
    ),
}
