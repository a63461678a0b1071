"""Files written and read again, and the SQL over the tables they were made from."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators import assoc, copies, graph, menu, vectors
from lavra.plans.graph_queries import _LIMITS, _chunk_baskets, _graph
from lavra.plans.menu_queries import _BASES, _entries
from lavra.plans.text_queries import _COPIES, _chunks, _tracked
from lavra.session import scratch, table
from lavra.sources import readers, sinks


def chunks_file(spark, d):
    """Titled chunks as JSON lines."""
    path = scratch(spark, "chunks")
    sinks.write_jsonl(_chunks(spark, d), path)
    c = readers.read_chunks(spark, path)
    return c.select("chunk_id", "doc_id", "position", "title", F.md5("text").alias("text"), F.array_join("key_phrases", "|").alias("key_phrases"), F.size("messages").alias("messages"))


def export_file(spark, d):
    """The test passages, a table of fixed size, as the documents of one JSON array in the order of their ids."""
    path = scratch(spark, "export")
    docs = table(spark, d, "eval_items").select("item_id", F.col("level").alias("name"), "text")
    one = docs.agg(F.sort_array(F.collect_list(F.struct("item_id", "name", "text"))).alias("d"))
    one.select(F.to_json(F.transform("d", lambda x: F.struct(x["name"].alias("name"), x["text"].alias("text")))).alias("value")).write.text(path)
    return readers.read_export(spark, path).select("doc_id", "doc_name", F.md5("text").alias("text"))


def menu_file(spark, d):
    """Menu entries as CSV with German-style separators and the headings of a menu."""
    path = scratch(spark, "menu")
    e = _entries(spark, d).select(F.col("code").alias("PROGRAMA"), F.col("label").alias("DESCRICAO"), F.col("type").alias("TIPO"))
    sinks.write_csv(e, path, ";", single=True)
    return menu.base_codes(menu.read_menu(spark, path)).select("code", "base", "label")


def terms_file(spark, d):
    """Part names by brand as lines of terms with their variants."""
    path = scratch(spark, "terms")
    p = table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ", ").alias("t"))
    lines = p.select(F.concat("p_brand", F.lit(": "), "t").alias("value")).unionByName(spark.createDataFrame([("# remark: none",), ("",), ("no colon",)], "value string"))
    lines.write.text(path)
    return readers.read_terms(spark, path)


def descriptions_file(spark, d):
    """Parts as described programs, with a heading and empty fields."""
    path = scratch(spark, "descriptions")
    p = table(spark, d, "part").select(F.concat(F.lit(" p"), "p_partkey").alias("program"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("description"))
    sinks.write_description_template(p, path)
    return readers.read_descriptions(spark, path)


def rules_file(spark, d):
    """Rules as the report shows them."""
    path = scratch(spark, "rules")
    sinks.write_rules(assoc.with_score(assoc.rules(_chunk_baskets(spark, d)[1], **_LIMITS)), path)
    r = spark.read.option("header", "true").csv(path)
    return r.select("from", "to", F.col("together").cast("long"), F.col("confidence").cast("double"), F.col("score").cast("double"))


def duplicates_file(spark, d):
    """Copies with the names of both documents."""
    path = scratch(spark, "duplicates")
    docs = _tracked(spark, d).withColumnRenamed("doc_name", "name")
    sinks.write_duplicates(copies.best_copies(copies.copy_candidates(docs)), docs, path)
    return spark.read.option("header", "true").option("sep", ";").csv(path).select(F.col("dropped_doc_id").cast("long"), F.col("kept_doc_id").cast("long"))


def graph_store(spark, d):
    """Two versions of the graph, the first one stored twice, the second one with a further column."""
    path = scratch(spark, "graph")
    run, node, edge = _graph(spark, d)
    keep = edge.select("edge_id", "from_node", "to_node", "weight", "version")
    for version, more in (("v1", False), ("v1", False), ("v2", True)):
        e = graph.of_version(keep, version).drop("version")
        sinks.save_run({"edge": e.withColumn("extra", F.lit(1)) if more else e}, path, version)
    return readers.read_graph(spark, path, "edge").select("version", "edge_id", "from_node", "to_node", "weight", "extra")


def vectors_store(spark, d):
    """Embeddings stored, replaced and read again."""
    path = scratch(spark, "vectors")
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), F.lit("h").alias("hash"), F.col("embedding").alias("vec"))
    sinks.save_vectors(e.withColumn("vec", F.reverse("vec")), path, 64)
    sinks.save_vectors(e, path, 64)
    return readers.read_vectors(spark, path).select("chunk_id", F.round(vectors.norm(F.col("vec")), 6).alias("norm"))


def evidence_text(spark, d):
    """The text of one chunk."""
    c = _chunks(spark, d)
    return graph.chunk_text(c, c.agg(F.min("chunk_id")).first()[0]).select(F.md5("text").alias("text"))


def passage_texts(spark, d):
    """Texts as models want them: with a prefix or without."""
    t = _tracked(spark, d)
    return t.select("doc_id", F.md5(vectors.passage_text(F.col("text"), "multilingual-e5-base")).alias("e5"), F.md5(vectors.passage_text(F.col("text"), "bge-m3")).alias("other"))


QUERIES = {
    "chunks_file": chunks_file, "export_file": export_file, "menu_file": menu_file, "terms_file": terms_file, "descriptions_file": descriptions_file, "rules_file": rules_file,
    "duplicates_file": duplicates_file, "graph_store": graph_store, "vectors_store": vectors_store, "evidence_text": evidence_text, "passage_texts": passage_texts,
}
_ONE = "c AS (SELECT chunk_id, any_value(doc_id) AS doc_id, any_value(position) AS position, any_value(title) AS title, any_value(text) AS text, any_value(key_phrases) AS key_phrases, any_value(messages) AS messages FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY 1)"
ORACLES = {
    "chunks_file": f"WITH {_ONE} SELECT chunk_id, doc_id, position, title, md5(text) AS text, array_to_string(key_phrases, '|') AS key_phrases, len(messages)::INT AS messages FROM c",
    "export_file": "SELECT row_number() OVER (ORDER BY item_id) - 1 AS doc_id, level AS doc_name, md5(text) AS text FROM eval_items",
    "menu_file": _BASES + " SELECT code, base, label FROM b",
    "terms_file": "SELECT DISTINCT p_brand AS name, unnest([p_brand, p_type]) AS variant FROM part",
    "descriptions_file": "SELECT 'P' || p_partkey AS program, p_name AS description FROM part WHERE p_partkey % 3 <> 0",
    "duplicates_file": f"WITH {_COPIES.split(',' + chr(10) + 'chain')[0]} SELECT dropped AS dropped_doc_id, kept AS kept_doc_id FROM best",
    "graph_store": "SELECT version, edge_id, from_node, to_node, weight, CASE WHEN version = 'v2' THEN 1 END AS extra FROM edge WHERE version IN ('v1', 'v2')",
    "vectors_store": "SELECT vec_id::VARCHAR AS chunk_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings",
    "evidence_text": f"WITH {_ONE} SELECT md5(text) AS text FROM c ORDER BY chunk_id LIMIT 1",
    "passage_texts": "SELECT doc_id, md5('passage: ' || text) AS e5, md5(text) AS other FROM documents",
}
