"""Descriptions of programs, put together from the menu, the rules and the chunks about them.

Chunks have main_programs, key_phrases and doc_name; a row order ``seq`` breaks ties by first
appearance. A program without any source gets its bare code. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.operators.assoc import split_codes


def item_names(titles: DataFrame, menu: DataFrame | None = None) -> DataFrame:
    """(code, name): the menu's name, else the one learnt from titles; both tables are (code, name)."""
    if menu is None:
        return titles
    m = menu.filter("name <> ''").select("code", F.col("name").alias("menu"))
    return titles.join(m, "code", "full").select("code", F.coalesce("menu", "name").alias("name"))


def program_phrases(chunks: DataFrame, most: int = 30) -> DataFrame:
    """(code, phrase, n, r): the most frequent key phrases of the chunks mainly about a program."""
    c = chunks.select("seq", F.explode(split_codes(F.col("main_programs"))).alias("code"), "key_phrases").select("code", "seq", F.posexplode("key_phrases").alias("pos", "phrase"))
    n = c.groupBy("code", "phrase").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "pos")).alias("first"))
    return _ranked(n, "phrase", most)


def program_documents(chunks: DataFrame, most: int = 3) -> DataFrame:
    """(code, document, n, r): the documents with most chunks mainly about a program, without file endings."""
    name = F.regexp_replace(F.coalesce("doc_name", F.lit("")), r"(?i)\.(?:pdf|docx)$", "")
    c = chunks.select("seq", F.explode(split_codes(F.col("main_programs"))).alias("code"), name.alias("document"))
    n = c.groupBy("code", "document").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    return _ranked(n, "document", most)


def _ranked(n: DataFrame, value: str, most: int) -> DataFrame:
    r = F.row_number().over(W.partitionBy("code").orderBy(F.desc("n"), "first", value))
    return n.withColumn("r", r).filter(F.col("r") <= most).drop("first")


def _listed(t: DataFrame, value: str, out: str) -> DataFrame:
    return t.groupBy("code").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", value))), lambda x: x[value]).alias(out))


def _sentence(head: str, values: Column, sep: str) -> Column:
    return F.when(F.size(values) > 0, F.concat(F.lit(head), F.array_join(values, sep), F.lit(".")))


def describe_programs(programs: DataFrame, chunks: DataFrame, names: DataFrame, terms: DataFrame, menu: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """(code, description, manual_description, related_terms, key_phrases, main_documents, menu_name, program_type, menu_variants, menu_entries).

    ``programs`` is (code); ``names`` (code, name) are learnt from titles; ``terms`` is (code, terms
    array) from the rules, strongest first; ``menu`` is the catalogue; ``manual`` (program, description).
    """
    spark = programs.sparkSession
    strings = "array<string>"
    menu = menu if menu is not None else spark.createDataFrame([], f"code string, name string, type string, variants {strings}, entries int")
    manual = manual if manual is not None else spark.createDataFrame([], "program string, description string")
    p = programs.join(names.select("code", F.col("name").alias("learnt")), "code", "left")
    p = p.join(menu.select("code", F.col("name").alias("menu_name"), F.col("type").alias("program_type"), "variants", F.col("entries").alias("menu_entries")), "code", "left")
    p = p.join(manual.select(F.col("program").alias("code"), F.col("description").alias("manual_description")), "code", "left").join(terms, "code", "left")
    frequent = _listed(program_phrases(chunks).filter("n >= 2"), "phrase", "phrases")
    p = p.join(frequent, "code", "left").join(_listed(program_documents(chunks), "document", "docs"), "code", "left")
    empty = F.array().cast(strings)
    p = p.withColumns({c: F.coalesce(c, empty) for c in ("variants", "terms", "phrases", "docs")}).withColumn("shown", F.coalesce("menu_name", "learnt"))
    words = F.regexp_extract_all(F.lower(F.coalesce("shown", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    new = lambda x: F.size(F.array_except(F.split(x, " "), words)) > 0
    apart = lambda x: ~F.exists("terms", lambda t: t.contains(x) | x.contains(t))
    p = p.withColumn("phrases", F.slice(F.filter("phrases", lambda x: new(x) & apart(x)), 1, 6))
    also = F.col("learnt").isNotNull() & ~F.lower("shown").contains(F.lower("learnt"))
    text = F.concat_ws(
        " ",
        F.concat("code", F.coalesce(F.concat(F.lit(" – "), "shown"), F.lit("")), F.lit(".")),
        F.concat(F.lit("Tipo: "), "program_type", F.lit(".")),
        F.concat(F.regexp_replace("manual_description", r"\.+$", ""), F.lit(".")),
        F.when(also, F.concat(F.lit("Nos documentos também aparece como: "), "learnt", F.lit("."))),
        _sentence("Variações no menu: ", F.slice("variants", 1, 4), "; "),
        _sentence("Assuntos: ", F.col("terms"), ", "),
        _sentence("Termos frequentes: ", F.col("phrases"), ", "),
        _sentence("Documentos: ", F.col("docs"), "; "),
    )
    return p.select("code", text.alias("description"), "manual_description", F.array_join("terms", ", ").alias("related_terms"), F.array_join("phrases", ", ").alias("key_phrases"),
                    F.array_join("docs", "; ").alias("main_documents"), "menu_name", "program_type", F.array_join(F.slice("variants", 1, 8), "; ").alias("menu_variants"), "menu_entries")
