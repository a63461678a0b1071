"""Vector search, links, clusters and audits over the embeddings and chunk vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.functions.text import body, module_of_programs, text_hash
from lavra.operators import links, phrases, vectors
from lavra.plans.text_queries import _C, _chunks
from lavra.session import table


def _embeddings(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").alias("cluster"))


def vec_norm(spark, d):
    return _embeddings(spark, d).select("id", F.round(vectors.norm(F.col("vec")), 6).alias("norm"), F.round(vectors.norm(vectors.l2_normalize(F.transform("vec", lambda x: x * 3))), 6).alias("unit"))


def vec_topk(spark, d):
    e = _embeddings(spark, d)
    q = vectors.vector_of(e, e.agg(F.min("id")).first()[0])
    return vectors.top_k(e, q, 10).withColumn("score", F.round("score", 6))


def vec_similar_to(spark, d):
    e = _embeddings(spark, d)
    return vectors.similar_to(e, e.agg(F.min("id")).first()[0], 10).withColumn("score", F.round("score", 6))


def knn_exact(spark, d):
    """Exact 5 nearest of every vector whose id is divisible by 20, against all."""
    e = _embeddings(spark, d)
    return vectors.exact_neighbours(e, e.filter("id % 20 = 0"), 5, 64).withColumn("similarity", F.round("similarity", 6))


def _links(spark, d):
    """Links of the queried vectors at 0.35 or more, typed by places that stand for documents and records."""
    c = _embeddings(spark, d).select(F.col("id").alias("chunk_id"), (F.col("id") % 7).alias("doc_id"), (F.col("id") % 3).alias("record"),
                                     F.concat(F.lit("t"), (F.col("id") % 21).cast("string")).alias("topic_id"), F.concat(F.lit("P"), F.col("cluster").cast("string")).alias("main_programs"),
                                     F.concat(F.lit("P"), (F.col("id") % 2).cast("string")).alias("mentioned_programs"))
    return links.typed_links(knn_exact(spark, d), c, 0.35)


def knn_links(spark, d):
    return _links(spark, d)


def link_relations(spark, d):
    return links.links_by_relation(_links(spark, d))


def near_duplicates(spark, d):
    return links.near_duplicates(_links(spark, d), 0.4).select("a", "b", "similarity")


def cluster_links(spark, d):
    return links.cluster_links(_links(spark, d), _embeddings(spark, d))


def strongest_cluster_links(spark, d):
    e = _embeddings(spark, d)
    words = e.select("cluster").distinct().select("cluster", F.array(F.concat(F.lit("k"), F.col("cluster").cast("string")), F.lit("l"), F.lit("m"), F.lit("n")).alias("keywords"))
    return links.strongest_cluster_links(cluster_links(spark, d), words)


def linked_clusters(spark, d):
    return links.linked_clusters(cluster_links(spark, d), 0)


def cluster_members(spark, d):
    return links.cluster_members(_labelled(spark, d), 1).select("chunk_id")


def cohesion(spark, d):
    return links.cohesion(_embeddings(spark, d)).select("cluster", "size", F.round("cohesion", 6).alias("cohesion"), "example")


def nmi(spark, d):
    e = _embeddings(spark, d).select((F.col("id") % 4).cast("string").alias("x"), F.col("cluster").alias("y"))
    return links.nmi(e).select(F.round("nmi", 6).alias("nmi"))


def _labelled(spark, d):
    """Chunks with a cluster: the last digits of the record, noise where it ends in nine."""
    c = _chunks(spark, d)
    cluster = F.when(F.col("record") % 10 != 9, F.col("record") % 10)
    return c.select("chunk_id", cluster.alias("cluster"), module_of_programs(F.col("main_programs")).alias("module"), F.lower(F.trim(F.regexp_replace("record_type", "-", ""))).alias("record_type"),
                    "doc_id", "record", "position", "topic_id", "topic_number", "text", "title", "doc_name")


def cluster_summary(spark, d):
    s = links.cluster_summary(_labelled(spark, d))
    return s.withColumns({c: F.round(c, 6) for c in ("module_purity", "largest_doc_share", "top_type_share")})


def form_clusters(spark, d):
    return links.form_clusters(links.cluster_summary(_labelled(spark, d)), 0.2)


def split_topics(spark, d):
    c = _labelled(spark, d).withColumn("cluster", F.col("position") % 3)
    return links.split_topics(c).select("topic_id", "chunks", F.array_join(F.transform("clusters", lambda x: x.cast("string")), " ").alias("clusters"))


def _placed(spark, d):
    """Chunks that have a vector of the full length, repeated deliveries once."""
    v = table(spark, d, "chunk_vectors").filter("size(vectors) = 192").groupBy("chunk_id").agg(F.min("vectors").alias("vec"))
    return _chunks(spark, d).select("chunk_id", "doc_id", "record", "position").join(v, "chunk_id")


def consecutive_similarity(spark, d):
    c = _placed(spark, d).withColumn("vec", vectors.l2_normalize(F.col("vec")))
    return links.consecutive_similarity(c).select("chunk_id", "next_id", F.round("similarity", 5).alias("similarity"), "side")


def stale_vectors(spark, d):
    v = table(spark, d, "chunk_vectors").select(F.col("chunk_id").alias("id"))
    return vectors.stale_ids(v, table(spark, d, "chunks_titled")).agg(F.count(F.lit(1)).alias("stale"))


def reuse(spark, d):
    """How many chunks find a stored vector of the full length by the hash of their text, for each model, and how many are to do."""
    c = _chunks(spark, d).select("chunk_id", "text", text_hash(body(F.col("text"), F.col("embed_text"))).alias("hash"))
    stored = table(spark, d, "chunk_vectors").select("hash", "model", F.when(F.size("vectors") == 192, F.col("vectors")).alias("vec"))
    out = None
    for (model,) in sorted(stored.filter("model is not null").select("model").distinct().limit(50).collect()):
        reused, todo = vectors.reuse_vectors(c, stored, {"model": model})
        one = reused.agg(F.lit(model).alias("model"), F.count(F.lit(1)).alias("reused")).crossJoin(todo.agg(F.count(F.lit(1)).alias("todo")))
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "model string, reused long, todo long")


def embedded(spark, d):
    """Every chunk's text encoded by the deterministic stand-in model; length of each vector."""
    c = _chunks(spark, d).select(text_hash(F.col("text")).alias("hash"), "text")
    return vectors.embed(c, vectors.hashing_encoder).select("hash", F.round(vectors.norm(F.col("vec")), 4).alias("norm"))


def tfidf_weights(spark, d):
    """Terms of every chunk and the largest of their unit weights."""
    t = vectors.tfidf(_chunks(spark, d).select(F.col("chunk_id").alias("id"), "text"))
    return t.select("id", F.size("terms").alias("terms"), F.round(F.array_max(F.transform("terms", lambda x: x["weight"])), 6).alias("largest"))


def tfidf_vectors(spark, d):
    """Every chunk's vector from the decomposition of these weights: its length and numbers."""
    v = vectors.tfidf_vectors(_chunks(spark, d).select(F.col("chunk_id").alias("id"), "text"), 64)
    return v.select("id", F.size("vec").alias("dims"), F.round(vectors.norm(F.col("vec")), 6).alias("norm"))


def vector_map(spark, d):
    _, xy = vectors.principal_components(_embeddings(spark, d), 2)
    return xy.select("id", F.round(F.get("xy", F.lit(0)), 6).alias("x"), F.round(F.get("xy", F.lit(1)), 6).alias("y"))


def phrase_df(spark, d):
    return phrases.phrase_counts(_chunks(spark, d)).groupBy("phrase").agg(F.count(F.lit(1)).alias("df"))


def phrase_scores(spark, d):
    return phrases.phrase_scores(_chunks(spark, d)).withColumn("score", F.round("score", 6))


def key_phrases(spark, d):
    return phrases.key_phrases(_chunks(spark, d)).withColumn("key_phrases", F.array_join("key_phrases", "|"))


def chunk_titles(spark, d):
    c = _chunks(spark, d).drop("title", "title_source", "key_phrases").withColumn("seq", F.struct("doc_id", "position"))
    return phrases.titles(c).withColumn("key_phrases", F.array_join("key_phrases", "|"))


def cluster_keywords(spark, d):
    return phrases.cluster_keywords(_labelled(spark, d).select(F.col("chunk_id").alias("id"), "cluster", "text")).withColumn("keywords", F.array_join("keywords", "|"))


def keyword_hits(spark, d):
    return links.keyword_hits(_chunks(spark, d), "Nota Fiscal")


def matching_points(spark, d):
    return links.matching_points(_labelled(spark, d), "fatu").select("chunk_id")


_E = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
_KNN = f"""WITH {_E}, n AS (SELECT id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM e),
k AS (SELECT * FROM (SELECT q.id, n.id AS neighbour, list_dot_product(q.v, n.v) AS s, row_number() OVER (PARTITION BY q.id ORDER BY round(list_dot_product(q.v, n.v), 12) DESC, n.id) AS r
  FROM n q JOIN n ON q.id <> n.id WHERE q.id % 20 = 0) WHERE r <= 5),
l AS (SELECT k.id AS a, neighbour AS b, round(s, 6) AS similarity, CASE WHEN k.id % 7 <> neighbour % 7 THEN 'other_document' WHEN k.id % 21 = neighbour % 21 THEN 'same_topic'
  WHEN k.id % 3 = neighbour % 3 THEN 'same_record' ELSE 'same_document' END AS relation, x.label AS la, y.label AS lb FROM k JOIN e x ON x.id = k.id JOIN e y ON y.id = neighbour WHERE round(s, 6) >= 0.35)"""
_LAB = _C.replace("any_value(topic_title) AS topic_title", "any_value(record) AS record, any_value(doc_id) AS doc_id, any_value(position) AS position, any_value(topic_id) AS topic_id, any_value(topic_number) AS topic_number, any_value(title) AS title, any_value(doc_name) AS doc_name, any_value(record_type) AS record_type")
QUERIES = {
    "vec_norm": vec_norm, "vec_topk": vec_topk, "vec_similar_to": vec_similar_to, "knn_exact": knn_exact, "knn_links": knn_links, "link_relations": link_relations, "near_duplicates": near_duplicates,
    "cluster_links": cluster_links, "cohesion": cohesion, "nmi": nmi, "cluster_summary": cluster_summary, "form_clusters": form_clusters, "split_topics": split_topics, "consecutive_similarity": consecutive_similarity,
    "stale_vectors": stale_vectors, "vector_reuse": reuse, "embedded_chunks": embedded, "tfidf_weights": tfidf_weights, "tfidf_vectors": tfidf_vectors, "vector_map": vector_map, "phrase_df": phrase_df, "phrase_scores": phrase_scores,
    "key_phrases": key_phrases, "chunk_titles": chunk_titles, "cluster_keywords": cluster_keywords, "keyword_hits": keyword_hits, "matching_points": matching_points,
    "strongest_cluster_links": strongest_cluster_links, "linked_clusters": linked_clusters, "cluster_members": cluster_members,
}
_TOP = "list_dot_product(v, (SELECT v FROM e WHERE id = (SELECT min(id) FROM e)))"
_SUMMARY = f"""WITH {_LAB}, l AS (SELECT record % 10 AS cluster, lower(trim(replace(record_type, '-', ''))) AS t, doc_id,
  list_distinct(list_transform(list_filter(regexp_split_to_array(coalesce(main_programs, ''), '\\s+'), lambda p: p <> ''), lambda p: regexp_extract(p, '^[A-Z]+'))) AS ms FROM c WHERE record % 10 <> 9),
m AS (SELECT cluster, t, doc_id, CASE WHEN len(ms) = 1 AND ms[1] <> '' THEN ms[1] END AS m FROM l),
mm AS (SELECT cluster, m, count(*) AS n, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, m) AS r FROM m WHERE m IS NOT NULL GROUP BY 1, 2),
tt AS (SELECT cluster, t, count(*) AS n, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, t) AS r FROM m WHERE t IS NOT NULL GROUP BY 1, 2),
dd AS (SELECT cluster, count(*) AS docs, max(n) AS big FROM (SELECT cluster, doc_id, count(*) AS n FROM m GROUP BY 1, 2) GROUP BY 1)
SELECT z.cluster, z.size, coalesce((SELECT m FROM mm WHERE mm.cluster = z.cluster AND r = 1), '') AS top_module, (SELECT round(max(n) / sum(n), 6) FROM mm WHERE mm.cluster = z.cluster) AS module_purity,
 coalesce((SELECT string_agg(m || ':' || n, ' ' ORDER BY r) FROM mm WHERE mm.cluster = z.cluster AND r <= 4), '') AS modules,
 coalesce((SELECT string_agg(t || ':' || n, ' ' ORDER BY r) FROM tt WHERE tt.cluster = z.cluster), '') AS record_types, docs AS documents, round(big / z.size, 6) AS largest_doc_share,
 (SELECT t FROM tt WHERE tt.cluster = z.cluster AND r = 1) AS top_record_type, (SELECT round(n / z.size, 6) FROM tt WHERE tt.cluster = z.cluster AND r = 1) AS top_type_share
FROM (SELECT cluster, count(*) AS size FROM m GROUP BY 1) z JOIN dd USING (cluster)"""
ORACLES = {
    "vector_reuse": f"WITH c AS (SELECT chunk_id, substr(sha1(split_part(any_value(embed_text), chr(10), 1) || chr(10) || regexp_replace(any_value(text), '\\[Imagem:[^\\]]*\\]', ' ', 'g')), 1, 16) AS hash FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY 1),"
    " m AS (SELECT DISTINCT model FROM chunk_vectors WHERE model IS NOT NULL), h AS (SELECT DISTINCT model, hash FROM chunk_vectors WHERE hash IS NOT NULL AND len(vectors) = 192)"
    " SELECT m.model, count(h.hash) AS reused, count(*) - count(h.hash) AS todo FROM m CROSS JOIN c LEFT JOIN h ON h.model = m.model AND h.hash = c.hash GROUP BY 1",
    "strongest_cluster_links": _KNN + ", p AS (SELECT least(la, lb) AS cluster_a, greatest(la, lb) AS cluster_b, count(*) AS links FROM l WHERE la <> lb GROUP BY 1, 2)"
    " SELECT cluster_a, cluster_b, links, 'k' || cluster_a || ', l, m' AS keywords_a, 'k' || cluster_b || ', l, m' AS keywords_b FROM p ORDER BY links DESC, cluster_a, cluster_b LIMIT 20",
    "linked_clusters": _KNN + ", p AS (SELECT least(la, lb) AS a, greatest(la, lb) AS b, count(*) AS links FROM l WHERE la <> lb GROUP BY 1, 2)"
    " SELECT CASE WHEN a = 0 THEN b ELSE a END AS cluster, links FROM p WHERE a = 0 OR b = 0 ORDER BY links DESC, cluster LIMIT 10",
    "cluster_members": f"WITH {_LAB} SELECT chunk_id FROM c WHERE record % 10 = 1 ORDER BY doc_id, position, chunk_id LIMIT 200",
    "cluster_summary": _SUMMARY,
    "matching_points": f"WITH {_LAB} SELECT chunk_id FROM (SELECT *, list_distinct(list_transform(list_filter(regexp_split_to_array(coalesce(main_programs, ''), '\\s+'), lambda p: p <> ''), lambda p: regexp_extract(p, '^[A-Z]+'))) AS ms FROM c)"
    " WHERE contains(lower(concat_ws(' ', title, doc_name, CASE WHEN len(ms) = 1 THEN ms[1] ELSE '' END, chunk_id)), 'fatu')",
    "vec_norm": f"WITH {_E} SELECT id, round(sqrt(list_dot_product(v, v)), 6) AS norm, 1.0 AS unit FROM e",
    "vec_topk": f"WITH {_E} SELECT id, round({_TOP}, 6) AS score FROM e ORDER BY {_TOP} DESC, id LIMIT 10",
    "vec_similar_to": f"WITH {_E} SELECT id, round({_TOP}, 6) AS score FROM e WHERE id <> (SELECT min(id) FROM e) ORDER BY {_TOP} DESC, id LIMIT 10",
    "knn_exact": _KNN + " SELECT id, neighbour, round(s, 6) AS similarity, r AS rank FROM k",
    "knn_links": _KNN + " SELECT a, b, similarity, relation, array_to_string(list_sort(list_intersect(list_distinct(['P' || la, 'P' || (a % 2)]), list_distinct(['P' || lb, 'P' || (b % 2)]))), ' ') AS shared_programs FROM l",
    "link_relations": _KNN + " SELECT relation, count(*) AS links FROM l GROUP BY 1",
    "near_duplicates": _KNN + " SELECT a, b, similarity FROM l WHERE similarity >= 0.4 AND a < b ORDER BY similarity DESC, a, b LIMIT 25",
    "cluster_links": _KNN + " SELECT least(la, lb) AS cluster_a, greatest(la, lb) AS cluster_b, count(*) AS links FROM l WHERE la <> lb GROUP BY 1, 2",
    "cohesion": f"WITH {_E}, m AS (SELECT label, i, avg(v[i]) AS x FROM e, unnest(range(1, 65)) AS u(i) GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY 1),"
    " s AS (SELECT e.label, id, list_dot_product(v, c) / (sqrt(list_dot_product(c, c)) + 1e-9) AS s FROM e JOIN c ON c.label = e.label)"
    " SELECT label AS cluster, count(*) AS size, round(avg(s), 6) AS cohesion, first(id ORDER BY round(s, 9) DESC, id) AS example FROM s GROUP BY 1",
    "nmi": "WITH t AS (SELECT vec_id % 4 AS x, label AS y, count(*) AS n FROM embeddings GROUP BY 1, 2), s AS (SELECT sum(n) AS t FROM t), px AS (SELECT x, sum(n) AS nx FROM t GROUP BY 1), py AS (SELECT y, sum(n) AS ny FROM t GROUP BY 1)"
    " SELECT round((SELECT sum(n / t * ln(n * t / (nx * ny))) FROM t JOIN px USING (x) JOIN py USING (y), s) / ((SELECT -sum(nx / t * ln(nx / t)) FROM px, s) + (SELECT -sum(ny / t * ln(ny / t)) FROM py, s)) * 2, 6) AS nmi",
    "stale_vectors": "SELECT count(*) AS stale FROM chunk_vectors WHERE chunk_id NOT IN (SELECT chunk_id FROM chunks_titled WHERE chunk_id IS NOT NULL)",
    "split_topics": f"WITH {_LAB} SELECT topic_id, count(*) AS chunks, array_to_string(list_sort(list_distinct(list(position % 3))), ' ') AS clusters FROM c WHERE coalesce(topic_number, '') <> '' AND topic_id IS NOT NULL"
    " GROUP BY 1 HAVING count(*) > 1 AND count(DISTINCT position % 3) > 1",
    "consecutive_similarity": f"WITH {_LAB}, v AS (SELECT chunk_id, min(vectors)::DOUBLE[] AS v FROM chunk_vectors WHERE len(vectors) = 192 GROUP BY 1),"
    " p AS (SELECT chunk_id, record, v, lead(chunk_id) OVER w AS nid, lead(record) OVER w AS nr, lead(v) OVER w AS nv FROM c JOIN v USING (chunk_id) WINDOW w AS (PARTITION BY doc_id ORDER BY position, chunk_id)),"
    " s AS (SELECT chunk_id, nid AS next_id, list_dot_product(v, nv) / ((sqrt(list_dot_product(v, v)) + 1e-12) * (sqrt(list_dot_product(nv, nv)) + 1e-12)) AS s FROM p WHERE nid IS NOT NULL AND record IS NOT DISTINCT FROM nr)"
    " SELECT chunk_id, next_id, round(s, 5) AS similarity, CASE WHEN s < 0.25 THEN 'low' ELSE 'high' END AS side FROM s WHERE s < 0.25 OR s > 0.92",
    "keyword_hits": f"WITH {_LAB} SELECT doc_id, doc_name, count(*) FILTER (contains(lower(concat_ws(' ', title, text)), 'nota fiscal')) AS hits, count(*) AS chunks FROM c GROUP BY 1, 2 HAVING hits > 0",
    "form_clusters": f"WITH {_LAB}, l AS (SELECT record % 10 AS cluster, lower(trim(replace(record_type, '-', ''))) AS t, doc_id FROM c WHERE record % 10 <> 9),"
    " z AS (SELECT cluster, count(*) AS size FROM l GROUP BY 1), dd AS (SELECT cluster, max(n) AS m FROM (SELECT cluster, doc_id, count(*) AS n FROM l GROUP BY 1, 2) GROUP BY 1),"
    " tt AS (SELECT cluster, first(t ORDER BY n DESC, t) AS t, max(n) AS n FROM (SELECT cluster, t, count(*) AS n FROM l WHERE t IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"
    " SELECT cluster, size, CASE WHEN m / size >= 0.2 THEN 'one_document' ELSE 'email' END AS form FROM z JOIN dd USING (cluster) LEFT JOIN tt USING (cluster) WHERE m / size >= 0.2 OR (t = 'email' AND n / size >= 0.2)",
}
