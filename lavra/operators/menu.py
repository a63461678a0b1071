"""The menu catalogue: official names, types, variants and customised codes of programs.

Entries are (code, label, type, seq). Codes with a suffix after an underscore count for the base
code. Null or foreign codes are dropped; null labels give no name; ``seq`` breaks ties by first
appearance. Extra columns are ignored.
"""

from __future__ import annotations

import re
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.functions.text import clean_label
from lavra.session import staged


def read_menu(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a menu CSV: encoding and delimiter are found from a sample, columns by name, else by place."""
    raw = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 1_000_000).alias("c")).first()
    data = bytes(raw[0]) if raw else b""
    try:
        sample, encoding = data.decode("utf-8-sig"), "UTF-8"
    except UnicodeDecodeError as e:
        cut = e.start >= len(data) - 4 and len(data) == 1_000_000  # a character cut by the sample's end
        encoding = "UTF-8" if cut else "ISO-8859-1"
        sample = data.decode("utf-8-sig", "ignore") if cut else data.decode("latin-1")
    head = sample[:2000]
    sep = ";" if head.count(";") > head.count(",") else ","
    t = spark.read.csv(path, sep=sep, encoding=encoding, header=True, multiLine=True, escape='"')
    names = {re.sub("﻿", "", c).lower().strip(): c for c in t.columns}
    places = list(t.columns)
    code = names.get("programa") or places[0]
    label = names.get("descricao") or names.get("descrição") or places[1]
    kind = F.col(f"`{names['tipo']}`") if "tipo" in names else F.lit(None).cast("string")
    return t.select(F.col(f"`{code}`").alias("code"), F.col(f"`{label}`").alias("label"), kind.alias("type"), F.monotonically_increasing_id().alias("seq"))


def base_codes(entries: DataFrame) -> DataFrame:
    """Entries with their code in upper case, its base and the cleaned label."""
    e = entries.withColumn("code", F.upper(F.trim("code"))).withColumn("base", F.substring_index("code", "_", 1))
    return e.filter(F.col("base").rlike(r"^[A-Z]{2,6}\d{1,4}\z")).withColumn("label", F.nullif(clean_label(F.col("label")), F.lit("")))


def common_names(entries: DataFrame, share: float = 0.4) -> DataFrame:
    """(base, name): the longest word prefix that at least 40 % of the labels share, two at least.

    Words are taken one at a time, always the most frequent next word (ties by first appearance)
    among the labels that agree so far. Each word place is one aggregation over all codes; below
    four characters the most frequent label stands in. It ends with the longest shared prefix.
    """
    labels = base_codes(entries).filter("label is not null").withColumn("w", F.split("label", r"\s+"))
    need = labels.groupBy("base").agg(F.greatest(F.lit(2), F.floor(F.count(F.lit(1)) * share)).alias("need"))
    top = labels.groupBy("base", "label").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    frequent = top.groupBy("base").agg(F.min(F.struct((-F.col("n")).alias("d"), "first", "label")).alias("m")).select("base", F.col("m.label").alias("frequent"))
    live = labels.join(need, "base").select("base", "need", "seq", "w")
    best = frequent.select("base", F.lit("").alias("prefix"))
    for i in count():
        word = F.lower(F.get("w", F.lit(i)))
        n = live.filter(word.isNotNull()).groupBy("base", word.alias("word"), "need").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.min_by("w", "seq").alias("shown"))
        win = n.groupBy("base").agg(F.min(F.struct((-F.col("n")).alias("d"), "first", "word", "shown", "need")).alias("m")).filter(-F.col("m.d") >= F.col("m.need"))
        win = win.select("base", F.col("m.word").alias("word"), F.array_join(F.slice("m.shown", 1, i + 1), " ").alias("longer"))
        win = staged(win, "menu")
        if win.isEmpty():
            break
        best = best.join(win.select("base", "longer"), "base", "left").select("base", F.coalesce("longer", "prefix").alias("prefix"))
        live = live.join(win.select("base", "word"), "base").filter(word == F.col("word")).drop("word")
    name = F.btrim("prefix", F.lit(" -–(,"))
    return best.join(frequent, "base").select("base", F.when(F.length(name) < 4, F.col("frequent")).otherwise(name).alias("name"))


def menu_catalogue(entries: DataFrame) -> DataFrame:
    """(code, name, type, variants, customised, entries) of every base code with a label."""
    b = base_codes(entries)
    names = common_names(entries)
    kinds = b.filter(F.trim("type") != "").groupBy("base", F.trim("type").alias("type")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    kind = kinds.groupBy("base").agg(F.min(F.struct((-F.col("n")).alias("d"), "first", "type")).alias("m")).select("base", F.col("m.type").alias("type"))
    n = b.groupBy("base").agg(F.count(F.lit(1)).cast("int").alias("entries"), F.array_sort(F.collect_set(F.when(F.col("code") != F.col("base"), F.col("code")))).alias("customised"))
    labels = b.filter("label is not null").groupBy("base", "label").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first")).join(names, "base")
    other = labels.filter(F.lower("label") != F.lower("name"))
    one = W.partitionBy("base", F.lower("label")).orderBy(F.desc("n"), "first")
    other = other.withColumn("r", F.row_number().over(one)).filter("r = 1")
    variants = other.groupBy("base").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("d"), "first", "label"))), lambda x: x["label"]).alias("variants"))
    out = names.join(kind, "base", "left").join(variants, "base", "left").join(n, "base")
    return out.select(F.col("base").alias("code"), "name", "type", F.coalesce("variants", F.array().cast("array<string>")).alias("variants"), "customised", "entries")
