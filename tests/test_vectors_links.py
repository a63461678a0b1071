import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lavra.operators import links, vectors


def table(spark, v):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, vec array<double>")


def test_exact_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((120, 8))
    v[7] = v[3] * 2  # the same direction
    v[9] = 0
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 3)
    df = table(spark, v).union(spark.createDataFrame([(500, None)], "id long, vec array<double>"))
    got = {(r.id, r["rank"]): (r.neighbour, r.similarity) for r in vectors.exact_neighbours(df, df.filter("id % 20 = 0 or id = 3"), 4, 8).collect()}
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    for q in [0, 20, 40, 60, 80, 100, 3]:
        s = u @ u[q]
        order = sorted((i for i in range(120) if i != q), key=lambda i: (-round(s[i], 12), i))[:4]
        assert [got[q, k + 1][0] for k in range(4)] == order
    assert got[3, 1] == (7, pytest.approx(1.0))
    assert vectors.exact_neighbours(df, df.filter("false"), 4, 8).count() == 0


def test_top_k_and_search(spark):
    df = table(spark, [[1, 0], [0.6, 0.8], [0, 1], [1, 0]])
    assert [tuple(r) for r in vectors.top_k(df, [1.0, 0.0], 3).collect()] == [(0, 1.0), (3, 1.0), (1, 0.6)]
    assert [r.id for r in vectors.similar_to(df, 0, 10).collect()] == [3, 1, 2]
    assert vectors.similar_to(df, 99, 3).count() == 0 and vectors.vector_of(df, 99) is None
    assert vectors.search(df, "x", lambda t: [0.0, 1.0], 999).count() == 4
    with pytest.raises(ValueError):
        vectors.search(df, "  ", lambda t: [0.0, 1.0])
    with pytest.raises(ValueError):
        vectors.check_compatible({"backend": "onnx", "pooling": "cls"}, {"backend": "onnx", "pooling": "mean"})
    n = df.union(spark.createDataFrame([(9, [0.0, 0.0])], "id long, vec array<double>")).select(vectors.norm(vectors.l2_normalize(F.col("vec")))).collect()
    assert [round(r[0], 6) for r in n] == [1, 1, 1, 1, 0]


def test_pooling_and_embedding(spark):
    h = np.arange(12, dtype=float).reshape(1, 3, 4)
    m = np.array([[1, 1, 0]])
    assert np.allclose(vectors.pool(h, m, "mean"), (h[:, :2].mean(1)) / np.linalg.norm(h[:, :2].mean(1)))
    assert np.allclose(vectors.pool(h, m, "cls"), h[:, 0] / np.linalg.norm(h[:, 0]))
    assert np.allclose(vectors.pool(h[:, 0], m, None), h[:, 0] / np.linalg.norm(h[:, 0]))
    t = spark.createDataFrame([("a", "nota fiscal"), ("a", "nota fiscal"), ("b", "x " * 500), ("n", None)], "hash string, text string")
    got = {r.hash: r.vec for r in vectors.embed(t, vectors.hashing_encoder).collect()}
    assert got.keys() == {"a", "b"} and np.allclose(got["a"], vectors.hashing_encoder()(["nota fiscal"])[0])
    c = spark.createDataFrame([("1", "a", "x"), ("2", "z", "y"), ("3", None, "w")], "chunk_id string, hash string, text string")
    reused, todo = vectors.reuse_vectors(c, spark.createDataFrame([("a", [1.0]), ("a", [1.0]), (None, [2.0]), ("z", None)], "hash string, vec array<float>"))
    assert [r.chunk_id for r in reused.collect()] == ["1"] and sorted(r.chunk_id for r in todo.collect()) == ["2", "3"]
    assert vectors.stale_ids(spark.createDataFrame([("1",), ("8",)], "id string"), c).count() == 1
    assert spark.range(1).select(vectors.passage_text(F.lit("t"), "x-e5-base")).first()[0] == "passage: t"


def test_tfidf(spark):
    t = spark.createDataFrame([(i, "nota fiscal saída") for i in range(4)] + [(i, "frete peso carga") for i in range(4, 8)] + [(8 + i, "zzz") for i in range(4)] + [(20, None)], "id int, text string")
    w = {r.id: {x.term: x.weight for x in r.terms} for r in vectors.tfidf(t, max_share=0.5).collect()}
    assert set(w[0]) == {"nota", "fiscal", "saída", "nota fiscal", "fiscal saída"} and 20 not in w
    assert sum(x * x for x in w[0].values()) == pytest.approx(1)
    v = {r.id: np.array(r.vec) for r in vectors.tfidf_vectors(t, 3, max_share=0.5).collect()}
    assert v[0] @ v[1] == pytest.approx(1) and abs(v[0] @ v[5]) < 1e-6


def test_projection(spark):
    rng = np.random.default_rng(0)
    v = rng.standard_normal((50, 5)) * [5, 3, 1, 0.1, 0.1]
    _, xy = vectors.principal_components(table(spark, v), 2)
    got = np.array([r.xy for r in xy.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(v - v.mean(0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :2] * s[:2]))


def nmi(pairs):
    n = len(pairs)
    c = lambda f: {k: sum(f(p) == k for p in pairs) for k in {f(p) for p in pairs}}
    x, y, j = c(lambda p: p[0]), c(lambda p: p[1]), c(lambda p: p)
    h = lambda d: -sum(v / n * math.log(v / n) for v in d.values())
    mi = sum(v / n * math.log(v * n / (x[a] * y[b])) for (a, b), v in j.items())
    return mi / ((h(x) + h(y)) / 2)


def test_nmi(spark):
    rng = random.Random(3)
    p = [(rng.choice("abc"), rng.randint(0, 3)) for _ in range(200)]
    df = spark.createDataFrame(p + [("", 1), (None, 1), ("a", -1), ("a", None)], "x string, y int")
    assert links.nmi(df).first()[0] == pytest.approx(nmi(p))
    assert links.nmi(spark.createDataFrame([("a", 1)] * 3, "x string, y int")).first()[0] == 1.0
    assert links.nmi(spark.createDataFrame([("a", 1), ("b", 1)], "x string, y int")).first()[0] == 0.0
    assert links.nmi(df.filter("false")).first()[0] is None


def test_links(spark):
    c = spark.createDataFrame([("a", 1, 1, "t", "P1 P2", None), ("b", 1, 1, "t", "P2", "P3"), ("c", 1, 1, None, None, "P1"), ("d", 1, 2, "", "", ""), ("e", 2, 1, "t", "P1", "")],
                              "chunk_id string, doc_id long, record int, topic_id string, main_programs string, mentioned_programs string")
    f = spark.createDataFrame([("a", "b", 0.99), ("a", "c", 0.98), ("a", "d", 0.6), ("a", "e", 0.97), ("b", "a", 0.99), ("a", "x", 0.9), ("c", "d", 0.1)], "id string, neighbour string, similarity double")
    got = links.typed_links(f, c)
    r = {(x.a, x.b): (x.relation, x.shared_programs) for x in got.collect()}
    assert r == {("a", "b"): ("same_topic", "P2"), ("b", "a"): ("same_topic", "P2"), ("a", "c"): ("same_record", "P1"), ("a", "d"): ("same_document", ""), ("a", "e"): ("other_document", "P1")}
    assert [(x.a, x.b) for x in links.near_duplicates(got).collect()] == [("a", "b"), ("a", "c"), ("a", "e")]
    lab = spark.createDataFrame([("a", 0), ("b", 1), ("c", -1), ("d", None), ("e", 2)], "id string, cluster int")
    cl = links.cluster_links(got, lab)
    assert {tuple(x) for x in cl.collect()} == {(0, 1, 2), (0, 2, 1)}
    kw = spark.createDataFrame([(0, ["x", "y", "z", "w"])], "cluster int, keywords array<string>")
    assert tuple(links.strongest_cluster_links(cl, kw, 1).first()) == (0, 1, 2, "x, y, z", None)
    assert [tuple(x) for x in links.linked_clusters(cl, 0).collect()] == [(1, 2), (2, 1)]


def test_summary_and_audit(spark):
    rows = [(f"c{i}", 0, "FATU" if i < 3 else "", "email", 1) for i in range(5)] + [(f"d{i}", 1, "PEDI", "email" if i < 8 else "teste", i) for i in range(9)] + [("n", -1, "X", "email", 1), ("m", None, "X", None, None)]
    s = links.cluster_summary(spark.createDataFrame(rows, "chunk_id string, cluster int, module string, record_type string, doc_id long"))
    r = {x.cluster: x for x in s.collect()}
    assert set(r) == {0, 1} and (r[0]["size"], r[0].top_module, r[0].module_purity, r[0].documents, r[0].largest_doc_share) == (5, "FATU", 1.0, 1, 1.0)
    assert r[1].record_types == "email:8 teste:1"
    assert {x.cluster: x.form for x in links.form_clusters(s).collect()} == {0: "one_document", 1: "email"}
    t = spark.createDataFrame([("t1", "1", 0), ("t1", "1", 1), ("t2", "1", 0), ("t2", "1", -1), ("t3", "", 0), ("t3", "", 1), (None, "1", 0)], "topic_id string, topic_number string, cluster int")
    assert [(x.topic_id, x.clusters) for x in links.split_topics(t).collect()] == [("t1", [0, 1])]
    v = spark.createDataFrame([("a", 1, 0, 0, [1.0, 0.0]), ("b", 1, 0, 1, [1.0, 0.0]), ("c", 1, 0, 2, [0.0, 1.0]), ("d", 1, 1, 3, [0.0, 1.0]), ("e", 1, 1, 4, None), ("f", 2, None, 0, [1.0, 0.0]), ("g", 2, None, 1, [0.5, 0.0])],
                              "chunk_id string, doc_id long, record int, position int, vec array<double>")
    assert {(x.chunk_id, x.next_id, x.side) for x in links.consecutive_similarity(v).collect()} == {("a", "b", "high"), ("b", "c", "low")}
    co = {x.cluster: x for x in links.cohesion(spark.createDataFrame([(1, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 0, [1.0, 1.0])], "id int, cluster int, vec array<double>")).collect()}
    assert co[0].example == 3 and co[0].cohesion == pytest.approx((2 / math.sqrt(2) + math.sqrt(2)) / 3)
    k = spark.createDataFrame([(1, "d", "Nota X", "y", "email"), (1, "d", None, None, "email"), (2, "e", None, "a nota", "teste")], "doc_id long, doc_name string, title string, text string, record_type string")
    assert {tuple(x) for x in links.keyword_hits(k, " NOTA ").collect()} == {(1, "d", 1, 2), (2, "e", 1, 1)}
    assert links.keyword_hits(k, "nota", "teste").count() == 1
