"""Association rules over chunk baskets, and queries over the stored graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators import assoc, graph
from lavra.plans.text_queries import _chunks
from lavra.session import table


def _items(spark, d):
    """Chunks with items, in document order, copied chunks left out."""
    c = _chunks(spark, d).withColumn("items", assoc.chunk_items(messages=True)).select("chunk_id", "doc_id", "record", "position", "topic_id", "topic_number", "text", "items")
    return assoc.drop_copied_chunks(c)


def _chunk_baskets(spark, d, unit="record"):
    c = _items(spark, d).withColumn("basket", assoc.basket_key(unit))
    return c, assoc.build_baskets(c.select("basket", F.col("doc_id").alias("doc"), F.explode_outer("items").alias("item")))


_LIMITS = {"min_confidence": 0.1, "min_lift": 2.0}


def chunk_rules(spark, d, unit="record"):
    r = assoc.with_score(assoc.rules(_chunk_baskets(spark, d, unit)[1], **_LIMITS))
    return r.withColumns({c: F.round(c, 6) for c in ("confidence", "lift", "conviction")})


def chunk_rule_evidence(spark, d):
    c, b = _chunk_baskets(spark, d)
    r = assoc.rules(b, **_LIMITS)
    rows = c.join(b.select("basket", "doc").distinct(), (c["basket"] == b["basket"]) & (c["doc_id"] == b["doc"]), "left_semi")
    rows = rows.select("chunk_id", "basket", F.col("doc_id").alias("doc"), F.struct("doc_id", "position").alias("seq"), "items")
    return assoc.evidence(rows, r)


def assoc_dedup_fingerprint(spark, d):
    return _items(spark, d).select("chunk_id")


def assoc_kind_thresholds(spark, d):
    """Rules between brands and part types as terms, each kind with its own thresholds."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    occ = j.select(F.col("l_orderkey").alias("basket"), F.col("o_custkey").alias("doc"), F.explode(F.array("p_brand", F.concat(F.lit("#"), "p_type"))).alias("item"))
    r = assoc.rules(assoc.build_baskets(occ), min_confidence=0.05, min_lift=1.01, term_confidence=0.03, term_lift=1.03)
    return r.select("from_item", "to_item", "kind", "cross_module", "together", F.round("lift", 6).alias("lift"))


def assoc_related_terms(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    occ = j.select(F.col("l_orderkey").alias("basket"), F.col("l_orderkey").alias("doc"), F.explode(F.array("p_brand", F.concat(F.lit("#"), "p_type"))).alias("item"))
    return assoc.related_terms(assoc.rules(assoc.build_baskets(occ), min_confidence=0.05, min_lift=0.5))


def _graph(spark, d):
    return tuple(table(spark, d, n) for n in ("run", "node", "edge"))


def _changed(spark, d):
    """Items that changed: of the latest version, the five nodes with most rules that do start edges, and one nobody knows."""
    run, node, edge = _graph(spark, d)
    v = graph.latest_version(run)
    starts = graph.of_version(edge, v).select(F.col("from_node").alias("node_id")).distinct()
    n = graph.of_version(node, v).join(starts, "node_id", "left_semi").orderBy(F.desc("rules_from"), "node_id").limit(5).select(F.lower("node_id").alias("item"))
    return n.unionByName(spark.createDataFrame([("zzzz9999",)], "item string"))


def graph_latest(spark, d):
    return graph.latest_version(table(spark, d, "run"))


def graph_inputs(spark, d):
    run, node, _ = _graph(spark, d)
    known, unknown = graph.split_inputs(_changed(spark, d), graph.of_version(node, graph.latest_version(run)))
    return known.withColumn("known", F.lit(1)).unionByName(unknown.withColumn("known", F.lit(0)))


def graph_edges(spark, d):
    run, _, edge = _graph(spark, d)
    return graph.walkable(graph.of_version(edge, graph.latest_version(run))).select("from_node", "to_node", "weight")


def _impact(hops):
    def run_(spark, d):
        r = graph.find_impact_candidates(*_graph(spark, d), _changed(spark, d), max_hops=hops, limit=1000, include_terms=True)
        return r.select("node", F.round("score", 6).alias("score"), "hops", F.col("cross_module").cast("int").alias("cross_module"))

    return run_


def impact_top(spark, d):
    """The 15 best candidates with their strongest path."""
    r = graph.find_impact_candidates(*_graph(spark, d), _changed(spark, d))
    return r.select("node", F.round("score", 6).alias("score"), "hops", F.size("paths").alias("paths"), F.array_join(F.get("paths", F.lit(0))["path"], " > ").alias("strongest"))


def impact_explained(spark, d):
    """The best candidates with node data and example chunks: chunks that mention the edge's target."""
    run, node, edge = _graph(spark, d)
    ranked = graph.find_impact_candidates(run, node, edge, _changed(spark, d))
    c = _chunks(spark, d)
    latest = graph.of_version(node, graph.latest_version(run))
    return graph.explain(ranked, latest, _mentions(edge, c), c).select("node", "node_type", "name", "module", F.round("score", 6).alias("score"), F.coalesce(F.size("evidence"), F.lit(0)).alias("examples"))


def _mentions(edge, chunks):
    """(edge_id, rank, chunk_id): the first three chunks whose main programs name the edge's target."""
    mention = chunks.select("chunk_id", F.explode(assoc.split_codes(F.col("main_programs"))).alias("to_node"))
    ids = mention.groupBy("to_node").agg(F.slice(F.array_sort(F.collect_set("chunk_id")), 1, 3).alias("ids"))
    return edge.select("edge_id", "to_node").distinct().join(ids, "to_node").select("edge_id", F.posexplode("ids").alias("rank", "chunk_id"))


def recommend_confidence(spark, d):
    run, _, edge = _graph(spark, d)
    r = graph.recommend_by_confidence(graph.of_version(edge, graph.latest_version(run)), _changed(spark, d))
    return r.withColumn("score", F.round("score", 6))


def graph_overview(spark, d):
    return graph.overview(table(spark, d, "edge")).select("version", "from_node", "to_node", "score")


def edge_full(spark, d):
    """Edges with names, module and their examples in order."""
    edge = table(spark, d, "edge")
    one = edge.groupBy("version", "from_node", "to_node").agg(F.min("edge_id").alias("edge_id"))
    e = graph.edge_full(one, table(spark, d, "node"), _mentions(edge, _chunks(spark, d)))
    return e.select("version", "from_node", "to_node", "from_name", "to_name", "to_module", "evidence")


def referenced_chunks(spark, d):
    c = _chunks(spark, d)
    return graph.referenced_chunks(c, _mentions(table(spark, d, "edge"), c)).select("chunk_id")


def run_listing(spark, d):
    return graph.run_listing(table(spark, d, "run")).select("version", "baskets", "rules")


def names_from_chunk_titles(spark, d):
    """Names read back from titles that are made of each chunk's topic and first main program."""
    from lavra.operators.phrases import names_from_titles

    c = _chunks(spark, d)
    named = F.concat("topic_title", F.lit(" ("), F.regexp_extract("main_programs", "[A-Z]{3,5}[0-9]{1,4}", 0), F.lit(") — "), "title")
    return names_from_titles(c.select(named.alias("title"), F.struct("doc_id", "position").alias("seq")))


_V = """v AS (SELECT version FROM run ORDER BY created_at DESC, version DESC LIMIT 1),
nd AS (SELECT node.* FROM node JOIN v USING (version)), ed AS (SELECT edge.* FROM edge JOIN v USING (version)),
inp AS (SELECT node_id AS item FROM nd WHERE node_id IN (SELECT from_node FROM ed) ORDER BY rules_from DESC, node_id LIMIT 5),
norm AS (SELECT DISTINCT CASE WHEN item LIKE '#%' THEN lower(item) ELSE upper(item) END AS item FROM inp),
known AS (SELECT item FROM norm WHERE item IN (SELECT node_id FROM nd)),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_node, to_node ORDER BY weight DESC, edge_id) AS k FROM ed WHERE weight >= 0.05) WHERE k = 1),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_node ORDER BY weight DESC, to_node) AS r FROM one) WHERE r <= 50),
h1 AS (SELECT item AS src, to_node AS node, weight AS s, [item, to_node] AS path, cross_module AS cm FROM known JOIN w ON from_node = item WHERE to_node <> item)"""
_ONE = "WITH " + _V + """, best AS (SELECT *, 1 AS hops FROM h1)"""
_TWO = "WITH " + _V + """,
h2 AS (SELECT * FROM (SELECT h1.src, w.to_node AS node, h1.s * w.weight * 0.5 AS s, list_append(h1.path, w.to_node) AS path, greatest(h1.cm, w.cross_module) AS cm,
       row_number() OVER (PARTITION BY h1.src, w.to_node ORDER BY h1.s * w.weight * 0.5 DESC, list_append(h1.path, w.to_node)) AS k
       FROM h1 JOIN w ON w.from_node = h1.node WHERE h1.node NOT LIKE '#%' AND NOT list_contains(h1.path, w.to_node)) WHERE k = 1),
a AS (SELECT src, node, s, path, cm, 1 AS hops FROM h1 UNION ALL SELECT src, node, s, path, cm, 2 FROM h2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, node ORDER BY s DESC, hops, path) AS b FROM a) WHERE b = 1)"""
_THREE = _TWO[: _TWO.index("a AS (SELECT src")] + """h3 AS (SELECT * FROM (SELECT h2.src, w.to_node AS node, h2.s * w.weight * 0.5 AS s, list_append(h2.path, w.to_node) AS path, greatest(h2.cm, w.cross_module) AS cm,
       row_number() OVER (PARTITION BY h2.src, w.to_node ORDER BY h2.s * w.weight * 0.5 DESC, list_append(h2.path, w.to_node)) AS k
       FROM h2 JOIN w ON w.from_node = h2.node WHERE h2.node NOT LIKE '#%' AND NOT list_contains(h2.path, w.to_node)) WHERE k = 1),
a AS (SELECT src, node, s, path, cm, 1 AS hops FROM h1 UNION ALL SELECT src, node, s, path, cm, 2 FROM h2 UNION ALL SELECT src, node, s, path, cm, 3 FROM h3),
""" + _TWO[_TWO.index("best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, node"):]
_EXAMPLES = """WITH mention AS (SELECT DISTINCT chunk_id, unnest(list_filter(regexp_split_to_array(coalesce(main_programs, ''), '\\s+'), lambda x: x <> '')) AS to_node FROM chunks_titled WHERE chunk_id IS NOT NULL),
ids AS (SELECT to_node, (list(chunk_id ORDER BY chunk_id))[1:3] AS ids FROM mention GROUP BY 1)"""
_RANK = """ SELECT node, round(1 - product(1 - s), 6) AS score, min(hops) AS hops, max(cm) AS cross_module FROM best WHERE node NOT IN (SELECT item FROM known)
GROUP BY node HAVING 1 - product(1 - s) >= 0.02 ORDER BY 1 - product(1 - s) DESC, node LIMIT 1000"""

QUERIES = {
    "chunk_rules": chunk_rules, "chunk_rules_topic": lambda s, d: chunk_rules(s, d, "topic"), "chunk_rule_evidence": chunk_rule_evidence, "assoc_dedup_fingerprint": assoc_dedup_fingerprint,
    "assoc_kind_thresholds": assoc_kind_thresholds, "assoc_related_terms": assoc_related_terms, "graph_latest": graph_latest, "graph_inputs": graph_inputs, "graph_edges": graph_edges,
    "impact_1hop": _impact(1), "impact_2hop": _impact(2), "impact_3hop": _impact(3), "impact_top": impact_top, "impact_explained": impact_explained, "recommend_confidence": recommend_confidence,
    "graph_overview": graph_overview, "edge_full": edge_full, "referenced_chunks": referenced_chunks, "run_listing": run_listing, "names_from_titles": names_from_chunk_titles,
}
_KT = """WITH occ AS (SELECT DISTINCT l_orderkey AS b, o_custkey AS doc, unnest([p_brand, '#' || p_type]) AS item FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
n AS (SELECT count(DISTINCT b) AS n FROM occ), ic AS (SELECT item, count(*) AS c FROM occ GROUP BY item),
pc AS (SELECT x.item AS a, y.item AS b, count(*) AS t, count(DISTINCT x.doc) AS d FROM occ x JOIN occ y ON x.b = y.b AND x.item < y.item WHERE NOT (x.item LIKE '#%' AND y.item LIKE '#%') GROUP BY 1, 2),
dir AS (SELECT a AS f, b AS g, t, d FROM pc UNION ALL SELECT b, a, t, d FROM pc),
m AS (SELECT f, g, t, t / x.c AS conf, (t / x.c) / (y.c / n.n) AS lift FROM dir JOIN ic x ON x.item = f JOIN ic y ON y.item = g, n WHERE t >= 3 AND d >= 3)
SELECT f AS from_item, g AS to_item, CASE WHEN f LIKE '#%' THEN 'term' ELSE 'program' END || '->' || CASE WHEN g LIKE '#%' THEN 'term' ELSE 'program' END AS kind,
CASE WHEN f LIKE '#%' OR g LIKE '#%' THEN 0 ELSE (regexp_extract(f, '^[A-Z]+') <> regexp_extract(g, '^[A-Z]+'))::INT END AS cross_module, t AS together, round(lift, 6) AS lift
FROM m WHERE CASE WHEN f LIKE '#%' AND g NOT LIKE '#%' THEN conf >= 0.03 AND lift >= 1.03 ELSE conf >= 0.05 AND lift >= 1.01 END"""
_RELATED = """WITH occ AS (SELECT DISTINCT l_orderkey AS b, unnest([p_brand, '#' || p_type]) AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT count(DISTINCT b) AS n FROM occ), ic AS (SELECT item, count(*) AS c FROM occ GROUP BY item),
pc AS (SELECT x.item AS f, y.item AS g, count(*) AS t FROM occ x JOIN occ y ON x.b = y.b AND x.item NOT LIKE '#%' AND y.item LIKE '#%' GROUP BY 1, 2),
m AS (SELECT f, g, t / x.c AS conf, (t / x.c) / (y.c / n.n) AS lift FROM pc JOIN ic x ON x.item = f JOIN ic y ON y.item = g, n WHERE t >= 3),
r AS (SELECT f, g, row_number() OVER (PARTITION BY f ORDER BY conf * log2(1 + least(round(lift, 2), 50)) DESC, g) AS k FROM m WHERE conf >= 0.05 AND lift >= 0.5)
SELECT f AS item, string_agg(substr(g, 2), ', ' ORDER BY k) AS related_terms FROM r WHERE k <= 6 GROUP BY f"""
_ITEMS = """c AS (SELECT chunk_id, any_value(doc_id) AS doc_id, any_value(record) AS record, any_value(position) AS position, any_value(topic_id) AS topic_id, any_value(topic_number) AS topic_number,
  any_value(text) AS text, any_value(main_programs) AS mp, any_value(mentioned_programs) AS xp, any_value(messages) AS ms FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id),
i0 AS (SELECT *, list_sort(list_distinct(list_concat(list_filter(regexp_split_to_array(coalesce(xp, '') || ' ' || coalesce(mp, ''), '\\s+'), lambda x: x <> ''),
  list_transform(list_concat(coalesce(ms, []), regexp_extract_all(coalesce(text, ''), '\\b(KND|ORA)-\\s?\\d+')), lambda m: regexp_replace(m, '\\s', '', 'g'))))) AS items FROM c),
i1 AS (SELECT *, row_number() OVER (PARTITION BY items, substr(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}_]+', '', 'g'), 1, 150) ORDER BY doc_id, position, chunk_id) AS rn FROM i0),
ch AS (SELECT * FROM i1 WHERE rn = 1 OR len(items) < 2)"""
_CHUNK_RULES = """, k AS (SELECT chunk_id, doc_id, position, {basket} AS b, items FROM ch),
bb AS (SELECT b, doc_id, list_sort(list_distinct(flatten(list(items)))) AS items, min((doc_id, position)) AS q, arg_min(chunk_id, (doc_id, position)) AS first FROM k GROUP BY ALL),
ok AS (SELECT * FROM bb WHERE len(list_filter(items, lambda x: NOT starts_with(x, '#'))) <= 25), n AS (SELECT count(*) AS n FROM ok),
o AS (SELECT b, doc_id, unnest(items) AS item FROM ok), ic AS (SELECT item, count(*) AS c FROM o GROUP BY 1),
pc AS (SELECT x.item AS a, y.item AS z, count(*) AS t, count(DISTINCT x.doc_id) AS d FROM o x JOIN o y ON x.b = y.b AND x.doc_id = y.doc_id AND x.item < y.item GROUP BY 1, 2),
dir AS (SELECT a AS f, z AS g, t, d FROM pc UNION ALL SELECT z, a, t, d FROM pc),
m AS (SELECT f, g, t, d, x.c AS cf, y.c AS cg, t / x.c AS conf, (t / x.c) / (y.c / n.n) AS lift, y.c / n.n AS py FROM dir JOIN ic x ON x.item = f JOIN ic y ON y.item = g, n WHERE t >= 3 AND d >= 3),
r AS (SELECT * FROM m WHERE conf >= 0.1 AND lift >= 2)"""
_KIND = "CASE WHEN contains({0}, '-') THEN 'message' ELSE 'program' END"
_MODULE = "CASE WHEN contains({0}, '-') THEN split_part({0}, '-', 1) ELSE regexp_extract({0}, '^[A-Z]+') END"
_RULE_ROWS = (
    " SELECT f AS from_item, g AS to_item, t AS together, d AS documents, cf AS from_baskets, cg AS to_baskets, round(conf, 6) AS confidence, round(lift, 6) AS lift,"
    " CASE WHEN t < cf THEN round((1 - py) / (1 - conf), 6) END AS conviction, " + _KIND.format("f") + " || '->' || " + _KIND.format("g") + " AS kind,"
    " (" + _MODULE.format("f") + " <> " + _MODULE.format("g") + ")::INT AS cross_module,"
    " round(t / (cf + 3) * log2(1 + least(round(lift, 2), 50)) * log2(1 + d), 3) AS score, round(t / (cf + 3), 4) AS weight FROM r"
)
_RECORD = "doc_id || '-r' || record"
_EVIDENCE = """, w AS (SELECT DISTINCT least(f, g) AS a, greatest(f, g) AS z FROM r),
p AS (SELECT w.a, w.z, ok.b, ok.doc_id, ok.first, row_number() OVER (PARTITION BY w.a, w.z ORDER BY q, ok.b) AS n FROM w JOIN ok ON list_contains(items, w.a) AND list_contains(items, w.z)),
e AS (SELECT p.*, coalesce((SELECT arg_min(chunk_id, (k.doc_id, k.position)) FROM k WHERE k.b = p.b AND list_contains(k.items, p.a) AND list_contains(k.items, p.z)), first) AS chunk_id FROM p WHERE n <= 30),
u AS (SELECT *, row_number() OVER (PARTITION BY a, z, doc_id ORDER BY n) AS d FROM e)
SELECT a, z AS b, rank, chunk_id FROM (SELECT a, z, chunk_id, row_number() OVER (PARTITION BY a, z ORDER BY n) AS rank FROM u WHERE d = 1) WHERE rank <= 3"""
_RULES_FILE = (
    " SELECT f AS \"from\", g AS \"to\", t AS together, round(conf, 3) AS confidence, round(t / (cf + 3) * log2(1 + least(round(lift, 2), 50)) * log2(1 + d), 3) AS score FROM r"
)
ORACLES = {
    "rules_file": f"WITH {_ITEMS}{_CHUNK_RULES.format(basket=_RECORD)}{_RULES_FILE}",
    "assoc_dedup_fingerprint": f"WITH {_ITEMS} SELECT chunk_id FROM ch",
    "chunk_rules": f"WITH {_ITEMS}{_CHUNK_RULES.format(basket=_RECORD)}{_RULE_ROWS}",
    "chunk_rules_topic": f"WITH {_ITEMS}{_CHUNK_RULES.format(basket=f"CASE WHEN coalesce(topic_number, '') <> '' AND topic_id IS NOT NULL THEN topic_id ELSE {_RECORD} END")}{_RULE_ROWS}",
    "chunk_rule_evidence": f"WITH {_ITEMS}{_CHUNK_RULES.format(basket=_RECORD)}{_EVIDENCE}",
    "assoc_kind_thresholds": _KT,
    "graph_latest": "SELECT version FROM run ORDER BY created_at DESC, version DESC LIMIT 1",
    "graph_inputs": "WITH " + _V + " SELECT item, 1 AS known FROM known UNION ALL SELECT 'ZZZZ9999', 0 UNION ALL SELECT item, 0 FROM norm WHERE item NOT IN (SELECT item FROM known)",
    "graph_edges": "WITH " + _V + " SELECT from_node, to_node, weight FROM w",
    "impact_1hop": _ONE + _RANK,
    "impact_2hop": _TWO + _RANK,
    "recommend_confidence": "WITH " + _V + ", e AS (SELECT from_node, to_node, max(confidence) AS c FROM ed WHERE documents >= 2 AND lift >= 2 AND from_node IN (SELECT item FROM norm) AND to_node NOT IN (SELECT item FROM norm) GROUP BY 1, 2)"
    " SELECT to_node AS node, round(1 - product(1 - c), 6) AS score FROM e GROUP BY 1",
    "graph_overview": "SELECT version, from_node, to_node, max(score) AS score FROM edge WHERE documents >= 2 AND lift >= 2 GROUP BY ALL ORDER BY score DESC, version, from_node, to_node LIMIT 60",
    "edge_full": _EXAMPLES + " SELECT e.version, e.from_node, e.to_node, f.name AS from_name, t.name AS to_name, t.module AS to_module, array_to_string(ids, ' ') AS evidence FROM (SELECT DISTINCT version, from_node, to_node FROM edge) e"
    " LEFT JOIN (SELECT version, node_id, min(name) AS name FROM node GROUP BY 1, 2) f ON f.version = e.version AND f.node_id = e.from_node"
    " LEFT JOIN (SELECT version, node_id, min(name) AS name, min(module) AS module FROM node GROUP BY 1, 2) t ON t.version = e.version AND t.node_id = e.to_node LEFT JOIN ids ON ids.to_node = e.to_node",
    "referenced_chunks": _EXAMPLES + " SELECT DISTINCT unnest(ids) AS chunk_id FROM ids WHERE to_node IN (SELECT to_node FROM edge)",
    "run_listing": "SELECT version, baskets, rules FROM run",
    "impact_3hop": _THREE + _RANK,
    "impact_top": _TWO + ", z AS (SELECT * FROM best WHERE node NOT IN (SELECT item FROM known) AND node NOT LIKE '#%') SELECT node, round(1 - product(1 - s), 6) AS score, min(hops) AS hops, count(*) AS paths,"
    " array_to_string(first(path ORDER BY round(s, 4) DESC, src, path), ' > ') AS strongest FROM z GROUP BY node HAVING 1 - product(1 - s) >= 0.02 ORDER BY 1 - product(1 - s) DESC, node LIMIT 15",
    "impact_explained": _TWO + ", z AS (SELECT * FROM best WHERE node NOT IN (SELECT item FROM known) AND node NOT LIKE '#%'), r AS (SELECT node, 1 - product(1 - s) AS s FROM z GROUP BY node HAVING 1 - product(1 - s) >= 0.02 ORDER BY s DESC, node LIMIT 15),"
    + _EXAMPLES[len("WITH "):] + " SELECT r.node, node_type, name, module, round(s, 6) AS score, least(coalesce(len(ids), 0), 2) AS examples FROM r LEFT JOIN (SELECT DISTINCT node_id, node_type, name, module FROM nd) n ON n.node_id = r.node LEFT JOIN ids ON ids.to_node = r.node",
    "assoc_related_terms": _RELATED,
    "names_from_titles": "WITH c AS (SELECT chunk_id, any_value(doc_id) AS d, any_value(position) AS p, any_value(topic_title) || ' (' || regexp_extract(any_value(main_programs), '[A-Z]{3,5}[0-9]{1,4}') || ') — ' || any_value(title) AS title FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id),"
    " x AS (SELECT d, p, i, trim(string_split(split_part(coalesce(title, ''), ' — ', 1), ' + ')[i]) AS part FROM c, unnest(range(1, len(string_split(split_part(coalesce(title, ''), ' — ', 1), ' + ')) + 1)) AS u(i)),"
    " h AS (SELECT d, p, i, regexp_extract(part, '^(.*) \\(([A-Z]{3,5}\\d{1,4})\\)$', 2) AS code, regexp_extract(part, '^(.*) \\(([A-Z]{3,5}\\d{1,4})\\)$', 1) AS name FROM x)"
    " SELECT code, name FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY d, p, i) AS k FROM h WHERE code <> '') WHERE k = 1",
}
