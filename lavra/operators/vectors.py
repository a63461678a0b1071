"""Vector functions: norms, exact top-k, exact neighbours in blocks, embedding with reuse.

Vectors are arrays; sums are in double. A zero vector has similarity 0 with all; null vectors are
dropped where neighbours are searched. Equal similarities go by id. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.functions import patterns as P
from lavra.session import staged

#: Query vectors that are broadcast to be compared with all rows, at most; more go block by block.
QUERY_BLOCK = 4096
#: Times that the weights are multiplied with the axes of a decomposition.
SVD_ROUNDS = 6


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    return F.transform(F.array(F.struct(v.alias("v"), (norm(v) + 1e-12).alias("n"))), lambda s: F.transform(s["v"], lambda x: x.cast("double") / s["n"]))[0]


def passage_text(text: Column, model: str, kind: str = "passage") -> Column:
    """Text with the prefix that E5 models want for its kind."""
    return F.concat(F.lit(f"{kind}: "), text) if re.search("e5", model, re.I) else text


def top_k(vectors: DataFrame, query: list[float], k: int, exclude=None) -> DataFrame:
    """(id, score): the k rows with the largest dot product with the query vector."""
    if not 1 <= k:
        raise ValueError("k must be 1 or more")
    q = F.array(*[F.lit(float(x)) for x in query])
    v = vectors.filter("vec is not null")
    if exclude is not None:
        v = v.filter(F.col("id") != exclude)
    return v.select("id", dot(F.col("vec"), q).alias("score")).orderBy(F.desc("score"), "id").limit(k)


def vector_of(vectors: DataFrame, id) -> list[float] | None:
    row = vectors.filter(F.col("id") == id).select("vec").first()
    return None if row is None or row[0] is None else [float(x) for x in row[0]]


def similar_to(vectors: DataFrame, id, k: int) -> DataFrame:
    """The k rows most similar to the row of an id, itself left out; an unknown id gives nothing."""
    q = vector_of(vectors, id)
    return top_k(vectors, q, k, exclude=id) if q is not None else vectors.limit(0).select("id", F.lit(0.0).alias("score"))


def search(vectors: DataFrame, text: str, encode: Callable[[str], list[float]], k: int = 10) -> DataFrame:
    """(id, score to 4 decimals) for a text query; k is kept within 1..200 and a blank query is refused."""
    if not text.strip():
        raise ValueError("an empty query")
    return top_k(vectors, encode(text), max(1, min(200, k))).withColumn("score", F.round("score", 4))


def check_compatible(stored: dict, wanted: dict) -> None:
    """Refuse to search vectors made by another backend or pooling."""
    for key in ("backend", "pooling"):
        if stored.get(key) != wanted.get(key):
            raise ValueError(f"vectors were made with {key}={stored.get(key)!r}, the query with {wanted.get(key)!r}")


def stale_ids(vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """Vector ids that no chunk has."""
    return vectors.select("id").join(chunks.select(F.col("chunk_id").alias("id")), "id", "left_anti")


def exact_neighbours(vectors: DataFrame, queries: DataFrame, k: int, dims: int) -> DataFrame:
    """(id, neighbour, similarity, rank): exact k nearest rows by cosine for each query, itself left out.

    Queries are a stated subset of the rows. Each block of them is broadcast and compared with all
    rows by matrix products, batch by batch; only the k best of a batch (and their equals) go on.
    """
    q = queries.filter("vec is not null").select("id", "vec")
    n = -(-q.count() // max(1, QUERY_BLOCK // 2))  # hashed blocks differ in size, so twice as many as needed
    blocks = q.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, n))))
    out = None
    for b in range(n):
        rows = blocks.filter(F.col("block") == b).orderBy("id").collect()  # about half of QUERY_BLOCK
        if not rows:
            continue
        found = _scan_block(vectors, [r["id"] for r in rows], np.array([r["vec"] for r in rows], dtype=np.float64), k, dims)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else vectors.sparkSession.createDataFrame([], f"id {vectors.schema['id'].dataType.simpleString()}, neighbour {vectors.schema['id'].dataType.simpleString()}, similarity double, rank int")


def _scan_block(vectors: DataFrame, ids: list, q: np.ndarray, k: int, dims: int) -> DataFrame:
    kind = vectors.schema["id"].dataType.simpleString()
    q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, q))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        for b in batches:
            if not len(b):
                continue
            v = np.array(b["vec"].tolist(), dtype=np.float64).reshape(len(b), dims)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            own = b["id"].to_numpy()
            sim = q @ v.T
            m = min(k + 1, sim.shape[1])
            at = np.argpartition(-sim, m - 1, 1)[:, :m] if m < sim.shape[1] else np.tile(np.arange(m), (len(q), 1))
            # ties at the edge: everything equal to the m-th best goes on
            edge = np.take_along_axis(sim, at, 1).min(1)
            r, c = np.nonzero(sim >= edge[:, None])
            f = pd.DataFrame({"id": [ids[i] for i in r], "neighbour": own[c], "similarity": sim[r, c]})
            yield f[f["id"] != f["neighbour"]]

    found = vectors.filter("vec is not null").select("id", "vec").mapInPandas(scan, f"id {kind}, neighbour {kind}, similarity double")
    best = W.partitionBy("id").orderBy(F.desc(F.round("similarity", 12)), "neighbour")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


# ------------------------------------------------------------------ embedding


def pool(hidden: np.ndarray, mask: np.ndarray, how: str | None) -> np.ndarray:
    """One unit vector a text from a model's output: already pooled, first token, or masked mean."""
    if hidden.ndim == 3:
        if how == "cls":
            hidden = hidden[:, 0]
        else:
            m = mask[..., None].astype(hidden.dtype)
            hidden = (hidden * m).sum(1) / np.maximum(m.sum(1), 1e-9)
    return (hidden / (np.linalg.norm(hidden, axis=1, keepdims=True) + 1e-12)).astype(np.float32)


def hashing_encoder(dims: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A deterministic stand-in for a model: words hashed to signed places, unit length."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims), np.float32)
        for i, t in enumerate(texts):
            for w in re.findall(r"\w+", (t or "").lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % dims] += 1 if h >> 63 else -1
        return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-12)

    return encode


def embed(texts: DataFrame, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 8) -> DataFrame:
    """(hash, vec) of texts (hash, text), one row a hash.

    Rows are ranged by length first, so that a batch holds texts of similar length; the encoder is
    made once a task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for b in batches:
            b = b.assign(n=b["text"].str.len()).sort_values("n", kind="stable")
            for a in range(0, len(b), batch):
                part = b.iloc[a : a + batch]
                yield pd.DataFrame({"hash": part["hash"], "vec": list(encode(part["text"].tolist()))})

    one = texts.filter("text is not null").groupBy("hash").agg(F.min("text").alias("text"))
    return one.repartitionByRange(F.length("text")).mapInPandas(run, "hash string, vec array<float>")


def reuse_vectors(chunks: DataFrame, stored: DataFrame, settings: dict[str, str | int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(reused, todo): chunks (chunk_id, hash, text) with the stored vector of their hash, and those without.

    Stored vectors count when hash and vector are there and they were made with the same
    ``settings``: columns such as model, file, text mode, pooling and length. Equal hashes give one
    vector; a null hash is no hash.
    """
    known = stored.filter("hash is not null and vec is not null")
    for name, value in (settings or {}).items():
        known = known.filter(F.col(name) == F.lit(value))
    known = known.groupBy("hash").agg(F.min("vec").alias("vec"))
    return chunks.join(known, "hash").select("chunk_id", "hash", "vec"), chunks.join(known, "hash", "left_anti")


def tfidf(texts: DataFrame, min_df: int = 3, max_share: float = 0.4, features: int = 60_000) -> DataFrame:
    """(id, terms): unit TF-IDF weights of words and word pairs, as an array of struct(term, weight).

    Sublinear term counts and smooth document frequency; the most frequent ``features`` terms.
    """
    words = F.filter(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?<![\p{L}\p{N}_])\p{L}{3,}(?![\p{L}\p{N}_])"), F.lit(0)), lambda w: ~w.isin(*sorted(set(P.CLUSTER_STOP.split()))))
    pairs = F.when(F.size(words) > 1, F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b)))
    grams = F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))
    tf = texts.select("id", F.explode(grams).alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("n"))
    docs = texts.agg(F.count(F.lit(1)).alias("docs"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("total")).crossJoin(F.broadcast(docs))
    df = df.filter((F.col("df") >= min_df) & (F.col("df") <= F.col("docs") * max_share)).orderBy(F.desc("total"), "term").limit(features)
    w = tf.join(df, "term").withColumn("w", (1 + F.log("n")) * (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1))
    g = w.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("t"))
    length = F.sqrt(F.aggregate("t", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
    return g.withColumn("l", length).select("id", F.transform("t", lambda x: F.struct(x["term"].alias("term"), (x["w"] / F.col("l")).alias("weight"))).alias("terms"))


def principal_components(vectors: DataFrame, parts: int) -> tuple[np.ndarray, DataFrame]:
    """(axes, (id, xy)): projection of (id, vec) on the principal axes of all rows.

    Mean and covariance are sums over all rows, one partial sum a partition. It stands in for the
    map projections that need a neighbour-embedding library. Null vectors are left out.
    """
    v = vectors.filter("vec is not null")
    dims = v.select(F.max(F.size("vec"))).first()[0] or 0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square, n = np.zeros(dims), np.zeros((dims, dims)), 0
        for b in batches:
            m = np.asarray(b.column(0).flatten(), dtype=np.float64).reshape(b.num_rows, dims)
            total, square, n = total + m.sum(0), square + m.T @ m, n + len(m)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[*total, *square.ravel()]], pa.list_(pa.float64()))], ["n", "s"])

    n, total = 0, np.zeros(dims + dims * dims)
    for r in v.select("vec").mapInArrow(sums, "n long, s array<double>").toLocalIterator():  # one row a partition, dims x dims numbers
        n, total = n + r["n"], total + np.array(r["s"])
    if not n:
        return np.zeros((parts, 1)), v.select("id", F.array().cast("array<double>").alias("xy"))
    mean = total[:dims] / n
    size, axes = np.linalg.eigh(total[dims:].reshape(dims, dims) / n - np.outer(mean, mean))
    axes = axes[:, np.argsort(-size, kind="stable")[:parts]].T
    axes = axes * np.where(axes[np.arange(len(axes)), np.abs(axes).argmax(1)] < 0, -1, 1)[:, None]  # signs made definite
    cols = [dot(F.col("vec"), F.array(*[F.lit(float(x)) for x in a])) - float(mean @ a) for a in axes]
    return axes, v.select("id", F.array(*cols).alias("xy"))


def tfidf_vectors(texts: DataFrame, dims: int = 256, **options) -> DataFrame:
    """(id, vec): unit vectors of the TF-IDF weights' singular value decomposition.

    The axes are found by subspace iteration: the weights, staged once, are multiplied with ``dims``
    axes over the cluster, and only ``features`` x ``dims`` numbers come to the driver each time.
    """
    kind = texts.schema["id"].dataType.simpleString()
    weights = staged(tfidf(texts, **options), "tfidf")
    names = [r[0] for r in weights.select(F.explode("terms").alias("t")).select("t.term").distinct().orderBy("term").collect()]  # at most ``features``
    n, spark = len(names), texts.sparkSession
    if not n:
        return spark.createDataFrame([], f"id {kind}, vec array<double>")
    at = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Rows]]:
        for b in batches:
            if b.num_rows:
                terms = b.column("terms")
                flat = terms.flatten()
                place = np.fromiter(map(at.value.__getitem__, flat.field("term").to_pylist()), np.int64, len(flat))
                yield b, Rows(np.asarray(terms.value_lengths()), place, np.asarray(flat.field("weight")))

    axes = np.linalg.qr(np.random.default_rng(7).standard_normal((n, min(dims, n))))[0]
    for _ in range(SVD_ROUNDS):
        shared = spark.sparkContext.broadcast(axes)

        def gram(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value)
            for _, r in rows(batches):
                r.add_back(r.times(shared.value), total)
            used = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(list(total[used]), pa.list_(pa.float64()))], ["at", "sums"])

        parts = weights.select("terms").mapInArrow(gram, "at long, sums array<double>")
        done = np.zeros_like(axes)
        for r in parts.groupBy("at").agg(F.collect_list("sums").alias("s")).select("at", F.aggregate("s", F.array_repeat(F.lit(0.0), axes.shape[1]), lambda a, x: F.zip_with(a, x, lambda p, q: p + q)).alias("s")).toLocalIterator():
            done[r["at"]] = r["s"]
        # the axes by size: the QR of the product turns them towards the largest singular values
        q, upper = np.linalg.qr(done)
        axes = q @ np.linalg.svd(upper)[0]
        shared.destroy()
    final = spark.sparkContext.broadcast(axes)  # at most features x dims numbers

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, r in rows(batches):
            v = r.times(final.value)
            v /= np.linalg.norm(v, axis=1, keepdims=True) + 1e-12
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(list(v), pa.list_(pa.float64()))], ["id", "vec"])

    return weights.mapInArrow(project, f"id {kind}, vec array<double>")


class Rows:
    """Sparse rows: how many entries each has, their columns and values, one after another."""

    def __init__(self, sizes: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.column, self.value = column, value

    def _parts(self) -> Iterator[tuple[int, int, int, int]]:
        """(first row, end row, first entry, end entry) of about 20,000 entries each."""
        marks = np.unique(np.searchsorted(self.first, np.arange(0, self.first[-1] + 20_000, 20_000)).clip(max=len(self.first) - 1))
        for i, j in pairwise(marks.tolist() if marks[0] == 0 else [0, *marks.tolist()]):
            yield i, j, int(self.first[i]), int(self.first[j])

    def times(self, axes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.first) - 1, axes.shape[1]))
        for i, j, a, b in self._parts():
            full = np.flatnonzero(np.diff(self.first[i : j + 1]))
            if len(full):
                out[i + full] = np.add.reduceat(self.value[a:b, None] * axes[self.column[a:b]], self.first[i + full] - a, axis=0)
        return out

    def add_back(self, y: np.ndarray, total: np.ndarray) -> None:
        row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        for _, _, a, b in self._parts():
            order = a + np.argsort(self.column[a:b], kind="stable")
            at, begin = np.unique(self.column[order], return_index=True)
            if len(at):
                total[at] += np.add.reduceat(self.value[order, None] * y[row[order]], begin, axis=0)
