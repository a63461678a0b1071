"""Embedding of chunks as they arrive: only texts whose hash is new are encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lavra.functions.text import text_hash
from lavra.operators.vectors import embed, reuse_vectors
from lavra.session import path_exists


def embed_stream(chunks: DataFrame, store: str, checkpoint: str, make_encoder: Callable, once: bool = True) -> StreamingQuery:
    """Keep a vector store (chunk_id, hash, vec) up to date with a stream of chunks (chunk_id, text).

    Each micro-batch joins its hashes with the store, encodes what is missing and writes the batch
    into a folder of its own, so that a batch that runs again replaces itself. Null texts are skipped.
    """
    spark = chunks.sparkSession
    schema = "chunk_id string, hash string, vec array<float>, batch long"

    def stored(before: int) -> DataFrame:
        # only a store that is not there is empty; any other failure to read it is one
        if not path_exists(spark, store):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(store).filter(F.col("batch") < before)

    def step(batch: DataFrame, number: int) -> None:
        b = batch.filter("text is not null").dropDuplicates(["chunk_id"]).select("chunk_id", "text", text_hash(F.col("text")).alias("hash"))
        reused, todo = reuse_vectors(b, stored(number))
        fresh = todo.join(embed(todo.select("hash", "text"), make_encoder), "hash").select("chunk_id", "hash", "vec")
        reused.select("chunk_id", "hash", "vec").unionByName(fresh).write.mode("overwrite").parquet(f"{store}/batch={number}")

    w = chunks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
