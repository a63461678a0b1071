"""Command line: python -m lavra.cli STAGE ... Each stage reads and writes the files of the pipeline."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lavra.functions.cleaning import clean_texts
from lavra.functions.text import body, text_hash
from lavra.operators import assoc, audit, chunking, copies, describe, graph, menu, phrases, terms, vectors
from lavra.session import path_exists, staged
from lavra.sources import readers, sinks


def chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    """Export -> chunks, topics and the list of copies."""
    docs = readers.read_export(spark, a.export).withColumn("text", clean_texts(F.col("text")))
    docs = staged(docs.withColumn("name", F.col("doc_name")), "cleaned")
    found = copies.resolve_chains(copies.best_copies(copies.copy_candidates(docs)))
    sinks.write_duplicates(found if not a.keep_duplicates else found.limit(0), docs, f"{a.out}/duplicates")
    kept = docs if a.keep_duplicates else copies.without_copies(docs, found)
    chunks = staged(chunking.chunk_documents(kept, raw=False), "chunks")
    topics = chunking.topics_of(kept, raw=False)
    rolled = staged(chunking.topic_rollup(topics, chunks), "topics")
    sinks.write_jsonl(chunking.relink_chunks(chunks, topics, rolled).select(*chunks.columns), f"{a.out}/chunks")
    sinks.write_jsonl(rolled, f"{a.out}/topics")
    print(sinks.report([("chunks", chunking.chunk_summary(chunks)), ("types", chunking.chunk_types(chunks))]))


def title(spark: SparkSession, a: argparse.Namespace) -> None:
    """Chunks -> titled chunks."""
    chunks = readers.read_chunks(spark, a.chunks, titled=False)
    names = menu.menu_catalogue(menu.read_menu(spark, a.menu)).select("code", "name") if a.menu else None
    t = phrases.titles(chunks, names)
    sinks.write_jsonl(chunks.drop("seq").join(t, "chunk_id"), a.out)
    print(sinks.report([("titles by source", t.groupBy("title_source").count().orderBy(F.desc("count")))]))


def rules(spark: SparkSession, a: argparse.Namespace) -> None:
    """Titled chunks -> rules, items and a version of the graph."""
    chunks = readers.read_chunks(spark, a.chunks)
    found = terms.find_terms(F.col("text"), terms.term_rules(readers.read_terms(spark, a.terms))) if a.terms else None
    c = chunks.withColumn("items", assoc.chunk_items(a.messages, found)).withColumn("basket", assoc.basket_key(a.unit))
    c = staged(assoc.drop_copied_chunks(c), "items")
    b = staged(assoc.build_baskets(c.select("basket", F.col("doc_id").alias("doc"), F.explode_outer("items").alias("item")), a.max_items), "baskets")
    r = assoc.rules(b, a.min_together, a.min_docs, a.min_confidence, a.min_lift, a.term_confidence, a.term_lift, a.term_term)
    r = staged(assoc.with_score(r), "rules")
    ev = assoc.evidence(c.join(b.select("basket", "doc"), (c["basket"] == b["basket"]) & (c["doc_id"] == b["doc"]), "left_semi").select("chunk_id", "basket", F.col("doc_id").alias("doc"), "seq", "items"), r)
    ev = staged(ev, "evidence")
    lists = ev.groupBy("a", "b").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "chunk_id"))), lambda x: x["chunk_id"]), " ").alias("evidence"))
    shown = r.withColumn("a", F.least("from_item", "to_item")).withColumn("b", F.greatest("from_item", "to_item")).join(lists, ["a", "b"], "left")
    sinks.write_rules(shown, f"{a.out}/rules")
    items = assoc.item_report(b, r)
    sinks.write_csv(items.orderBy(F.desc("baskets"), "item"), f"{a.out}/items", single=True)
    catalogue = menu.menu_catalogue(menu.read_menu(spark, a.menu)) if a.menu else None
    names = phrases.names_from_titles(chunks)
    related = assoc.related_terms(r).select(F.col("item").alias("code"), F.split("related_terms", ", ").alias("terms"))
    manual = readers.read_descriptions(spark, a.descriptions) if a.descriptions else None
    programs = items.filter(assoc.kind_of(F.col("item")) == "program").select(F.col("item").alias("code"))
    d = staged(describe.describe_programs(programs, chunks, names, related, catalogue, manual), "descriptions")
    named = describe.item_names(names, None if catalogue is None else catalogue.select("code", "name"))
    node = items.select(F.col("item").alias("node_id"), assoc.kind_of(F.col("item")).alias("node_type"), "module", "baskets", "documents", "rules_from").join(named.select(F.col("code").alias("node_id"), "name"), "node_id", "left")
    node = node.join(d.withColumnRenamed("code", "node_id"), "node_id", "left")
    edge = r.select(F.xxhash64("from_item", "to_item").alias("edge_id"), F.col("from_item").alias("from_node"), F.col("to_item").alias("to_node"), F.lit("co_mentioned").alias("relation"), F.lit("docs_assoc").alias("source"),
                    "kind", "together", "documents", "from_baskets", "to_baskets", "confidence", "lift", "conviction", "score", "weight", "cross_module")
    pairs = r.select(F.xxhash64("from_item", "to_item").alias("edge_id"), F.least("from_item", "to_item").alias("a"), F.greatest("from_item", "to_item").alias("b"))
    used = pairs.join(ev, ["a", "b"]).select("edge_id", "rank", "chunk_id")
    totals = assoc.totals(b).first()
    params = json.dumps({k: v for k, v in vars(a).items() if k not in ("stage", "out", "run")}, ensure_ascii=False)
    run = spark.range(1).select(F.current_timestamp().cast("string").alias("created_at"), F.lit(a.chunks).alias("chunks_file"), F.lit(a.unit).alias("unit"), F.lit(params).alias("params_json"),
                                F.lit(totals[0]).alias("baskets"), F.lit(totals[1]).alias("documents"), F.lit(items.count()).alias("items"), F.lit(r.count()).alias("rules"))
    kept = graph.referenced_chunks(chunks.select("chunk_id", "doc_id", "doc_name", "title", "record_type", "pedido", "topic_id", "text"), used)
    sinks.save_run({"run": run, "node": node, "edge": edge, "edge_evidence": used, "chunk": kept}, f"{a.out}/graph", a.run)
    print(sinks.report([("run", assoc.run_report(b, r)), ("strongest rules", r.orderBy(F.desc("score"), "from_item", "to_item").select("from_item", "to_item", "together", "documents", "score")),
                        ("strongest rules between modules", r.filter("cross_module = 1").orderBy(F.desc("score"), "from_item", "to_item").select("from_item", "to_item", "together", "documents", "score")),
                        ("items with most rules", items.orderBy(F.desc("rules_from"), "item").select("item", "rules_from", "baskets"))], 20))


def impact(spark: SparkSession, a: argparse.Namespace) -> None:
    """Graph and changed items -> ranked candidates."""
    run, node, edge = (readers.read_graph(spark, a.graph, n) for n in ("run", "node", "edge"))
    if a.runs:
        print(sinks.report([("runs", graph.run_listing(run).select("version", "created_at", "items", "rules"))]))
        return
    items = spark.createDataFrame([(i,) for i in a.items], "item string")
    r = graph.find_impact_candidates(run, node, edge, items, a.max_hops, a.limit, a.run, a.min_weight, a.hop_penalty, a.min_score, a.relations, a.include_terms)
    print(sinks.payload(r, a.limit))


#: The stand-in encoder; a model's encoder and name take its place where there is one.
ENCODER, MODEL = vectors.hashing_encoder, "hashing-64"


def embed(spark: SparkSession, a: argparse.Namespace) -> None:
    """Titled chunks -> vectors; stored vectors of the same text, model, mode and length are used again."""
    text = body(F.col("text"), F.col("embed_text")) if a.header else body(F.col("text"))
    c = readers.read_chunks(spark, a.chunks).select("chunk_id", text.alias("text")).filter("text is not null").withColumn("hash", text_hash(F.col("text")))
    made = {"model": MODEL, "text_mode": "header" if a.header else "body", "dims": 64}
    known = readers.read_vectors(spark, a.out) if path_exists(spark, a.out) else spark.createDataFrame([], "hash string, vec array<float>, model string, text_mode string, dims int")
    reused, todo = vectors.reuse_vectors(c, known, made)
    fresh = todo.select("chunk_id", "hash").join(vectors.embed(todo.select("hash", "text"), ENCODER), "hash").select("chunk_id", "hash", "vec")
    both = staged(reused.unionByName(fresh).withColumns({k: F.lit(v) for k, v in made.items()}), "vectors")
    new = todo.count()  # before the set it was compared with is replaced
    print(f"{sinks.save_vectors(both, a.out, made['dims'])} vectors, {new} of them new")


def search(spark: SparkSession, a: argparse.Namespace) -> None:
    """Vectors and a text query, or a chunk id -> the most similar chunks."""
    v = readers.read_vectors(spark, a.vectors)
    stored = v.select("model").first()
    vectors.check_compatible({"backend": stored[0] if stored else MODEL}, {"backend": MODEL})
    v = v.select(F.col("chunk_id").alias("id"), "vec")
    found = vectors.similar_to(v, a.query, a.k) if a.similar else vectors.search(v, a.query, lambda t: ENCODER()([t])[0].tolist(), a.k)
    if a.chunks:
        found = found.join(readers.read_chunks(spark, a.chunks).select(F.col("chunk_id").alias("id"), "title", "doc_name"), "id", "left").orderBy(F.desc("score"), "id")
    print(sinks.payload(found, a.k))


def audit_stage(spark: SparkSession, a: argparse.Namespace) -> None:
    """Chunks, vectors and clusters -> links, summaries and the quality report."""
    v = readers.read_vectors(spark, a.vectors).select("chunk_id", "vec")
    ids = v.select(F.col("chunk_id").alias("id"), "vec")
    near = spark.read.parquet(a.neighbours) if a.neighbours else vectors.exact_neighbours(ids, ids, a.k, v.select(F.max(F.size("vec"))).first()[0] or 1)
    done = audit.audit(readers.read_chunks(spark, a.chunks).drop("seq"), v, spark.read.parquet(a.clusters), staged(near, "neighbours"), a.least)
    print(done.write(a.out))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lavra")
    sub = p.add_subparsers(dest="stage", required=True)
    s = sub.add_parser("chunk", help=chunk.__doc__)
    s.add_argument("export"), s.add_argument("--out", default="out"), s.add_argument("--keep-duplicates", action="store_true")
    s = sub.add_parser("title", help=title.__doc__)
    s.add_argument("chunks"), s.add_argument("--out", default="out/chunks_titled"), s.add_argument("--menu")
    s = sub.add_parser("rules", help=rules.__doc__)
    s.add_argument("chunks"), s.add_argument("--out", default="out"), s.add_argument("--unit", choices=["chunk", "topic", "record", "document"], default="record")
    s.add_argument("--messages", action="store_true"), s.add_argument("--terms"), s.add_argument("--term-term", action="store_true"), s.add_argument("--menu"), s.add_argument("--descriptions"), s.add_argument("--run", default="latest")
    for name, kind, default in (("term-confidence", float, 0.03), ("term-lift", float, 3.0), ("min-together", int, 3), ("min-docs", int, 3), ("min-confidence", float, 0.2), ("min-lift", float, 2.0), ("max-items", int, 25)):
        s.add_argument("--" + name, type=kind, default=default)
    s = sub.add_parser("impact", help=impact.__doc__)
    s.add_argument("graph"), s.add_argument("items", nargs="*"), s.add_argument("--run"), s.add_argument("--runs", action="store_true"), s.add_argument("--relations", nargs="*"), s.add_argument("--include-terms", action="store_true")
    for name, kind, default in (("max-hops", int, 2), ("limit", int, 15), ("min-weight", float, 0.05), ("hop-penalty", float, 0.5), ("min-score", float, 0.02)):
        s.add_argument("--" + name, type=kind, default=default)
    s = sub.add_parser("embed", help=embed.__doc__)
    s.add_argument("chunks"), s.add_argument("--out", default="out/vectors"), s.add_argument("--header", action="store_true")
    s = sub.add_parser("search", help=search.__doc__)
    s.add_argument("vectors"), s.add_argument("query"), s.add_argument("--similar", action="store_true"), s.add_argument("--chunks"), s.add_argument("-k", type=int, default=10)
    s = sub.add_parser("audit", help=audit_stage.__doc__)
    s.add_argument("chunks"), s.add_argument("vectors"), s.add_argument("clusters"), s.add_argument("--neighbours"), s.add_argument("--out", default="out"), s.add_argument("-k", type=int, default=5), s.add_argument("--least", type=float, default=0.55)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("lavra").getOrCreate()
    {"chunk": chunk, "title": title, "rules": rules, "impact": impact, "embed": embed, "search": search, "audit": audit_stage}[a.stage](spark, a)


if __name__ == "__main__":
    main()
