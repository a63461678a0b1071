"""Text functions over documents and chunks, chunking, and copy detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.functions import cleaning, patterns, text
from lavra.functions.fold import fold_col
from lavra.operators import chunking, copies, terms
from lavra.session import table

_MODULES = "|".join(patterns.MODULES)
_B = r"[\s\x{00A0}]"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text", F.col("source").alias("name"))


def _chunks(spark, d):
    """Chunk rows, each chunk id once."""
    c = table(spark, d, "chunks_titled").filter("chunk_id is not null")
    cols = [x for x in c.columns if x not in ("chunk_id", "loaded_at")]
    return c.groupBy("chunk_id").agg(*[F.first(x, ignorenulls=False).alias(x) for x in cols])


def _text(**columns):
    return lambda spark, d: _docs(spark, d).select("doc_id", *[f(F.col("text")).alias(n) for n, f in columns.items()])


def _chunk_text(**columns):
    return lambda spark, d: _chunks(spark, d).select("chunk_id", *[f().alias(n) for n, f in columns.items()])


_C = "c AS (SELECT chunk_id, any_value(text) AS text, any_value(embed_text) AS embed_text, any_value(main_programs) AS main_programs, any_value(topic_title) AS topic_title FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id)"
_LIST = "array_to_string(list_sort(list_distinct({})), ' ')"


def labels(spark, d):
    """Menu labels made from part names, with the prefixes menus use."""
    p = table(spark, d, "part").select("p_partkey", "p_name")
    n = F.col("p_partkey") % 100
    made = F.when(n % 4 == 0, F.concat(n.cast("string"), F.lit(" - "), F.col("p_name"))).when(n % 4 == 1, F.concat(F.lit("**novo** "), F.col("p_name"))).when(n % 4 == 2, F.concat(F.lit("-  06) - "), F.col("p_name"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", text.clean_label(made).alias("label"))


def term_items(spark, d):
    """Terms of a small dictionary found in every chunk."""
    rows = [("nota fiscal", "nota fiscal"), ("nota fiscal", "nf-e"), ("estoque", "inventári*"), ("pedido", "pedido de venda"), ("pedido", "pedido de compra"), ("frete", "conhecimento de frete")]
    rules = terms.term_rules(spark.createDataFrame(rows, "name string, variant string"))
    c = _chunks(spark, d).select("chunk_id", F.explode(terms.find_terms(F.col("text"), rules)).alias("term"))
    return c.groupBy("term").agg(F.count(F.lit(1)).alias("chunks"))


def _tracked(spark, d):
    """Documents under the names of their files."""
    return table(spark, d, "documents").select("doc_id", F.col("doc_name"), "text")


def copy_pairs(spark, d):
    return copies.copy_candidates(_tracked(spark, d).withColumnRenamed("doc_name", "name"))


def copy_best(spark, d):
    return copies.best_copies(copy_pairs(spark, d))


def copy_resolved(spark, d):
    return copies.resolve_chains(copy_best(spark, d))


def documents_without_copies(spark, d):
    return copies.without_copies(_docs(spark, d), copy_resolved(spark, d)).select("doc_id")


def shingle_df(spark, d):
    return copies.shingle_frequency(_docs(spark, d)).groupBy("df").agg(F.count(F.lit(1)).alias("shingles"))


def chunk_documents(spark, d):
    """Every document cleaned and cut into chunks."""
    return chunking.chunk_documents(_tracked(spark, d))


def chunk_topics(spark, d):
    """Topics that have chunks, linked past those that have none: chunks of less than 200 characters don't count here."""
    c = _chunks(spark, d).filter("topic_id is not null")
    t = c.groupBy("topic_id").agg(F.min("doc_id").alias("doc_id"), F.min("previous_topic_id").alias("previous_topic_id"))
    held = c.filter(F.length("text") >= 200).select("topic_id")
    return chunking.topic_rollup(t, held).select("topic_id", "previous_topic_id", "n_chunks")


def chunk_types(spark, d):
    return chunking.chunk_types(_chunks(spark, d))


def chunk_stats(spark, d):
    return chunking.chunk_summary(_chunks(spark, d))


def line_classes(spark, d):
    """Lines of documents by whether they look like code or prose."""
    lines = _docs(spark, d).select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(text.looks_like_code(F.col("line")).alias("code"), text.looks_like_prose(F.col("line")).alias("prose")).agg(F.count(F.lit(1)).alias("lines"))


def cleaned_documents(spark, d):
    return _docs(spark, d).select("doc_id", cleaning.clean_texts(F.col("text")).alias("text"))


_SHINGLES = """
w AS (SELECT doc_id, regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '\\[(imagem|código):[^\\]]*\\]', ' ', 'g'), '[\\p{L}\\p{N}_]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
df AS (SELECT s, count(*) AS df FROM s GROUP BY s)"""
_COPIES = _SHINGLES + """,
z AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
r AS (SELECT s.* FROM s JOIN df USING (s) WHERE df BETWEEN 2 AND 20),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM r x JOIN r y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
nm AS (SELECT doc_id, coalesce(doc_name, '') AS name, list_sort(list_distinct(list_filter(regexp_extract_all(coalesce(doc_name, ''), '\\b[A-Z]{3,5}[0-9]{1,4}\\b'), lambda c: regexp_full_match(c, '(' || '""" + _MODULES + """' || ')[0-9]+')))) AS codes FROM documents),
p AS (SELECT CASE WHEN (za.size, na.name, a) < (zb.size, nb.name, b) THEN a ELSE b END AS dropped, CASE WHEN (za.size, na.name, a) < (zb.size, nb.name, b) THEN b ELSE a END AS kept, n,
      least(za.size, zb.size) AS s, greatest(za.size, zb.size) AS l, na.codes AS ca, nb.codes AS cb FROM o JOIN z za ON za.doc_id = a JOIN z zb ON zb.doc_id = b JOIN nm na ON na.doc_id = a JOIN nm nb ON nb.doc_id = b),
cand AS (SELECT dropped, kept, n FROM p WHERE s >= 30 AND n / s >= 0.6 AND s / l >= 0.7 AND NOT (len(ca) > 0 AND len(cb) > 0 AND ca <> cb)),
best AS (SELECT dropped, kept FROM (SELECT *, row_number() OVER (PARTITION BY dropped ORDER BY n DESC, kept) AS k FROM cand) WHERE k = 1),
chain AS (SELECT dropped, kept FROM best UNION ALL SELECT c.dropped, b.kept FROM chain c JOIN best b ON b.dropped = c.kept),
final AS (SELECT * FROM chain c WHERE kept NOT IN (SELECT dropped FROM best))"""

QUERIES = {
    "text_whitespace": _text(squeezed=lambda t: F.md5(text.squeeze(t))),
    "text_codes": _text(codes=lambda t: F.array_join(text.codes(t), " ")),
    "text_hash": _text(hash=text.text_hash),
    "text_shorten": _text(short=text.shorten),
    "text_record_type": _text(record_type=text.record_type),
    "text_substance": _text(substance=lambda t: F.length(text.substance(t)).cast("long")),
    "text_messages": _text(messages=lambda t: F.array_join(text.messages(t), " ")),
    "text_heading": _text(heading=text.heading),
    "text_fields": _text(fields=lambda t: F.array_join(text.fields(t), "|")),
    "text_caption_tails": _text(n=lambda t: F.length(text.drop_caption_tails(t)).cast("long")),
    "text_topic_title": _text(title=text.topic_title),
    "fold_accents": _chunk_text(folded=lambda: F.md5(fold_col(F.col("topic_title")))),
    "chunk_body": _chunk_text(body=lambda: F.md5(text.body(F.col("text"), F.col("embed_text")))),
    "chunk_module": _chunk_text(module=lambda: text.module_of_programs(F.col("main_programs"))),
    "chunk_subject": _chunk_text(subject=lambda: text.email_subject(F.col("text"))),
    "chunk_code_tables": _chunk_text(tables=lambda: F.array_join(text.code_tables(F.col("text")), " ")),
    "clean_label": labels, "term_items": term_items, "line_classes": line_classes, "cleaned_documents": cleaned_documents,
    "shingle_df": shingle_df, "copy_pairs": copy_pairs, "copy_best": copy_best, "copy_resolved": copy_resolved, "documents_without_copies": documents_without_copies,
    "chunk_documents": chunk_documents, "chunk_topics": chunk_topics, "chunk_stats": chunk_stats, "chunk_types": chunk_types,
}
_SQUEEZED = f"btrim_(regexp_replace(text, '{_B}+', ' ', 'g'))".replace("btrim_(", "trim(").replace("'g'))", "'g'), ' .:-–')")
ORACLES = {
    "text_whitespace": f"SELECT doc_id, md5(regexp_replace(regexp_replace(replace(text, chr(13), ''), '[ \\t]+', ' ', 'g'), '\\n[ \\t]*\\n{_B}*', chr(10) || chr(10), 'g')) AS squeezed FROM documents",
    "text_codes": "SELECT doc_id, " + _LIST.format(f"list_filter(regexp_extract_all(coalesce(text, ''), '\\b[A-Z]{{3,5}}[0-9]{{1,4}}\\b'), lambda c: regexp_full_match(c, '({_MODULES})[0-9]+'))") + " AS codes FROM documents",
    "text_hash": "SELECT doc_id, substr(sha1(text), 1, 16) AS hash FROM documents",
    "text_shorten": f"SELECT doc_id, CASE WHEN length(s) <= 90 THEN s ELSE regexp_replace(substr(s, 1, 90), ' [^ ]*$', '') || '…' END AS short FROM (SELECT doc_id, {_SQUEEZED} AS s FROM documents)",
    "text_record_type": "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)Pedido\\s+(de\\s+)?Servi[çc]o:?\\s*\\d+') THEN 'pedido' WHEN starts_with(text, 'De:') OR starts_with(text, 'E-mail —') THEN 'email'"
    " WHEN starts_with(lower(text), 'testes') THEN 'teste' ELSE 'documentacao' END AS record_type FROM documents",
    "text_substance": "SELECT doc_id, length(regexp_replace(regexp_replace(trim(regexp_replace(text, '\\[(Imagem|Código):[^\\]]*\\]', '', 'g')), '^E-mail —( Assunto:)?', ''), '[^\\p{L}\\p{N}_]', '', 'g')) AS substance FROM documents",
    "text_messages": "SELECT doc_id, " + _LIST.format("list_transform(regexp_extract_all(coalesce(text, ''), '\\b(KND|ORA)-\\s?\\d+'), lambda m: regexp_replace(m, '\\s', '', 'g'))") + " AS messages FROM documents",
    "text_topic_title": "SELECT doc_id, trim(substr(regexp_replace(regexp_split_to_array(text, '\\s\\d{1,2}\\.\\d{1,2}[.)]\\s|\\n')[1], '^\\d{1,2}\\s?[.)=]\\s*', ''), 1, 140)) AS title FROM documents",
    "fold_accents": f"WITH {_C} SELECT chunk_id, md5(strip_accents(lower(topic_title))) AS folded FROM c",
    "chunk_body": f"WITH {_C} SELECT chunk_id, md5(split_part(embed_text, chr(10), 1) || chr(10) || regexp_replace(text, '\\[Imagem:[^\\]]*\\]', ' ', 'g')) AS body FROM c",
    "chunk_module": f"WITH {_C}, m AS (SELECT chunk_id, list_distinct(list_transform(list_filter(regexp_split_to_array(coalesce(main_programs, ''), '\\s+'), lambda p: p <> ''), lambda p: regexp_extract(p, '^[A-Z]+'))) AS m FROM c)"
    " SELECT chunk_id, CASE WHEN len(m) = 1 THEN m[1] ELSE '' END AS module FROM m",
    "chunk_subject": f"WITH {_C} SELECT chunk_id, regexp_replace(trim(regexp_extract(coalesce(text, ''), '(?m)^(E-mail — )?Assunto:[ \\t]*([^\\n]+)$', 2), ' ' || chr(13)), '(?i)^((RE|RES|ENC|FW|FWD|TR)\\s*:\\s*)+', '') AS subject FROM c",
    "chunk_code_tables": f"WITH {_C} SELECT chunk_id, " + _LIST.format("list_filter(flatten(list_transform(regexp_extract_all(coalesce(text, ''), '\\[Código: ([^\\]]*)\\]', 1), lambda x: regexp_split_to_array(x, '\\s+'))), lambda x: x <> '')") + " AS tables FROM c",
    "clean_label": "SELECT p_partkey, p_name AS label FROM part",
    "shingle_df": f"WITH {_SHINGLES} SELECT df, count(*) AS shingles FROM df GROUP BY df",
    "copy_pairs": f"WITH {_COPIES.split(',' + chr(10) + 'best')[0]} SELECT * FROM cand",
    "copy_best": f"WITH {_COPIES.split(',' + chr(10) + 'chain')[0]} SELECT * FROM best",
    "copy_resolved": f"WITH RECURSIVE {_COPIES} SELECT dropped, kept FROM final",
    "documents_without_copies": f"WITH {_COPIES.split(',' + chr(10) + 'chain')[0]} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT dropped FROM best)",
    "chunk_types": "WITH c AS (SELECT chunk_id, any_value(record_type) AS record_type, any_value(topic_number) AS topic_number, any_value(topic_id) AS topic_id FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id),"
    " e AS (SELECT record_type, CASE WHEN topic_number <> '' THEN topic_id END AS t, count(*) AS n FROM c GROUP BY 1, 2) SELECT record_type, sum(n)::BIGINT AS chunks, count(t) AS topics, count(*) FILTER (t IS NOT NULL AND n = 1) AS whole FROM e GROUP BY 1",
    "chunk_topics": "WITH c AS (SELECT chunk_id, any_value(topic_id) AS topic_id, any_value(doc_id) AS doc_id, any_value(previous_topic_id) AS p, any_value(text) AS text FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id),"
    " t AS (SELECT topic_id, min(doc_id) AS doc_id, min(p) AS p, regexp_extract(topic_id, '(\\d+)$', 1)::INT AS o, count(*) FILTER (length(text) >= 200)::INT AS n FROM c WHERE topic_id IS NOT NULL GROUP BY 1),"
    " ch AS (SELECT *, sum((p IS NULL)::INT) OVER (PARTITION BY doc_id ORDER BY o) AS chain FROM t)"
    " SELECT x.topic_id, (SELECT max_by(y.topic_id, y.o) FROM ch y WHERE y.doc_id = x.doc_id AND y.chain = x.chain AND y.o < x.o AND y.n > 0) AS previous_topic_id, x.n AS n_chunks FROM ch x WHERE x.n > 0",
    "chunk_stats": f"WITH {_C}, n AS (SELECT split_part(chunk_id, '-', 1) AS d, coalesce(length(text), 0) AS n FROM c)"
    " SELECT count(DISTINCT d) AS documents, count(*) AS chunks, median(n) AS median, max(n) AS longest, count(*) FILTER (n < 400) AS short,"
    " (SELECT n FROM (SELECT n, row_number() OVER (ORDER BY n) AS k FROM n) WHERE k = (SELECT floor(count(*) * 0.95) + 1 FROM n)) AS p95 FROM n",
}
