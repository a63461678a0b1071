"""Readers of the files that the pipeline's stages exchange. Each reads with a stated schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.chunking import CHUNK_SCHEMA

TITLED_SCHEMA = CHUNK_SCHEMA + ", title string, title_source string, key_phrases array<string>"


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, doc_name, text) of a JSON array of documents; the id is the place in the array."""
    whole = spark.read.text(path, wholetext=True)
    items = whole.select(F.posexplode(F.from_json("value", "array<struct<name:string,text:string>>")).alias("doc_id", "d"))
    return items.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("d.name").alias("doc_name"), F.col("d.text").alias("text"))


def read_chunks(spark: SparkSession, path: str, titled: bool = True) -> DataFrame:
    """Chunks of JSON lines, in file order given by ``seq``; missing fields are null."""
    t = spark.read.schema(TITLED_SCHEMA if titled else CHUNK_SCHEMA).json(path)
    return t.withColumn("seq", F.struct("doc_id", "position"))


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """(name, variant) of lines "name: variant, variant*"; the name is a variant too. Blank lines, comments and lines without a colon are skipped."""
    line = F.trim("value")
    t = spark.read.text(path).filter((line != "") & ~line.startswith("#") & line.contains(":"))
    name, rest = F.trim(F.substring_index(line, ":", 1)), F.substr(line, F.instr(line, ":") + 1)
    v = t.select(name.alias("name"), F.explode(F.concat(F.array(name), F.split(rest, ","))).alias("variant"))
    return v.select("name", F.trim("variant").alias("variant")).filter("variant <> ''")


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """(program, description) of lines "program;description"; a heading row and empty fields are skipped; the last row of a program wins."""
    t = spark.read.csv(path, sep=";", schema="program string, description string", escape='"').withColumn("seq", F.monotonically_increasing_id())
    code = F.upper(F.trim(F.regexp_replace("program", "﻿", "")))
    t = t.select(code.alias("program"), F.trim("description").alias("description"), "seq").filter("program <> '' and program <> 'PROGRAM' and description <> ''")
    return t.groupBy("program").agg(F.max_by("description", "seq").alias("description"))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_graph(spark: SparkSession, path: str, name: str, version: str | None = None) -> DataFrame:
    """A table of the graph store; columns added by later runs are merged, a version prunes partitions."""
    t = spark.read.option("mergeSchema", "true").option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    t = t.withColumn("version", F.col("version").cast("string"))
    return t if version is None else t.filter(F.col("version") == version)
