"""Writers. Folders are replaced whole; a graph run replaces only its own version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.session import move_path


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", quoted: bool = True, single: bool = False) -> None:
    """CSV with a heading; ``single`` puts the sorted report into one file."""
    w = (df.coalesce(1) if single else df).write.mode("overwrite").option("header", "true").option("sep", sep).option("escape", '"').option("emptyValue", "")
    (w if quoted else w.option("quote", "\u0000")).csv(path)


def write_duplicates(copies: DataFrame, documents: DataFrame, path: str) -> None:
    """dropped_doc_id;dropped_doc;kept_doc_id;kept_doc, by dropped id."""
    n = documents.select("doc_id", "name")
    j = copies.join(n.select(F.col("doc_id").alias("dropped"), F.col("name").alias("dropped_doc")), "dropped").join(n.select(F.col("doc_id").alias("kept"), F.col("name").alias("kept_doc")), "kept")
    write_csv(j.select(F.col("dropped").alias("dropped_doc_id"), "dropped_doc", F.col("kept").alias("kept_doc_id"), "kept_doc").orderBy("dropped_doc_id"), path, ";", quoted=False, single=True)


def write_rules(rules: DataFrame, path: str) -> None:
    """Rules by score, rounded as the report shows them, an infinite conviction as ``inf``."""
    shown = rules.orderBy(F.desc("score"), "from_item", "to_item").select(
        F.col("from_item").alias("from"), F.col("to_item").alias("to"), "together", "documents", "from_baskets", "to_baskets", F.round("confidence", 3).alias("confidence"), F.round("lift", 2).alias("lift"),
        F.coalesce(F.round("conviction", 2).cast("string"), F.lit("inf")).alias("conviction"), "cross_module", "kind", *[c for c in ("evidence",) if c in rules.columns], "score",
    )
    write_csv(shown, path, single=True)


def write_description_template(descriptions: DataFrame, path: str) -> None:
    """program;description;..., with a byte order mark before the first heading."""
    first, *rest = descriptions.columns
    write_csv(descriptions.withColumnRenamed(first, "﻿" + first), path, ";", single=True)


def save_run(tables: dict[str, DataFrame], path: str, version: str) -> None:
    """Replace one version of every graph table (run, node, edge, edge_evidence, chunk); other versions stay."""
    for name, df in tables.items():
        df.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{path}/{name}")


def save_vectors(vectors: DataFrame, path: str, dims: int) -> int:
    """Write (chunk_id, hash, vec) once all vectors are of the stated length; returns their number."""
    n, bad = vectors.agg(F.count(F.lit(1)), F.count_if(F.coalesce(F.size("vec"), F.lit(-1)) != dims)).first()
    if bad:
        raise ValueError(f"{bad} of {n} vectors are not of length {dims}")
    vectors.write.mode("overwrite").parquet(f"{path}.tmp")
    move_path(vectors.sparkSession, f"{path}.tmp", path)  # readers see the old set or the new one, never a part
    return n


def payload(df: DataFrame, rows: int = 5000) -> str:
    """At most ``rows`` rows as JSON for a page, with closing tags made harmless."""
    lines = [r[0] for r in df.limit(rows).select(F.to_json(F.struct(*df.columns))).collect()]
    return "[" + ",".join(lines).replace("</", "<\\/") + "]"


def report(sections: list[tuple[str, DataFrame]], rows: int = 25) -> str:
    """A text report of small aggregates: a heading and at most ``rows`` lines each."""
    out = []
    for title, df in sections:
        out.append(title)
        out += ["   " + "  ".join("" if v is None else str(v) for v in r) for r in df.limit(rows).collect()]
        out.append("")
    return "\n".join(out)


def write_report(spark, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
