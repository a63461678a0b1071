"""Session helpers: the shared scratch folder, staged tables and input tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "chunks_titled chunk_vectors edge node run eval_items quality_labels"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary folder is made and set; on a cluster
    a folder of one machine would be lost to the others, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lavra-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/lavra/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, but the copy is columnar and compressed, later
    readers prune columns, and lost executors cost nothing because the files are shared.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def move_path(spark: SparkSession, source: str, to: str) -> None:
    """Put a finished folder in the place of another, by renaming."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, to))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {to}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path on whatever file system it lies."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this library left in the shared folder; results that read it must be stored before."""
    drop_path(spark, f"{shared_dir(spark)}/lavra")
