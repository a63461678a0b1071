import re
import unicodedata

import numpy as np
import pytest

from lavra.llm.leakage import align, leaked_passages


def words(s):
    s = "".join(c for c in unicodedata.normalize("NFD", (s or "").lower()) if unicodedata.category(c) != "Mn")
    return re.findall("[a-z0-9]+", s)


def brute(docs, items, n=12):
    owner = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - n + 1):
            owner.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = words(t)
        for k in range(len(w) - n + 1):
            o = owner.get(tuple(w[k : k + n]), set())
            if len(o) == 1:
                out.add((d, *o))
    return out


def corpus(rng):
    v = [f"palavra{i}" for i in range(60)] + ["é", "de", "Código"]
    shared = " ".join(rng.choices(v, k=30))
    items = [(i, " ".join(rng.choices(v, k=rng.randint(5, 60))) + (" " + shared if i % 3 == 0 else "")) for i in range(25)]
    items += [(90, None), (91, ""), (92, items[1][1]), (2, items[2][1])]
    docs = []
    for d in range(200):
        w = rng.choices(v, k=rng.randint(0, 80))
        if d % 2:
            source = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(source) - 1))
            w[10:10] = source[a : a + rng.choice([8, 11, 12, 13, 40])]
        docs.append((d, ", ".join(w).upper() if d % 5 == 0 else " ".join(w)))
    docs += [(900, None), (901, ""), (902, "!!"), (903, "x " * 60000 + items[4][1]), (1, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("limit", [2_000_000])
def test_exact_cases(spark, rng, limit):
    docs, items = corpus(rng)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = leaked_passages(d, i, broadcast_words=limit).filter("longest >= 12").select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in got} == brute(docs, items)


def test_shuffled_way_finds_the_same(spark, rng):
    docs, items = corpus(rng)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = {(r.doc_id, r.item_id) for r in leaked_passages(d, i).filter("longest >= 12").collect()}
    two = {(r.doc_id, r.item_id) for r in leaked_passages(d, i, broadcast_words=0).filter("longest >= 12").collect()}
    assert one == two == brute(docs, items)


def test_edited_copy_scores(spark, rng):
    text = " ".join(f"termo{k}" for k in range(60))
    w = text.split()
    edited = " ".join(x for k, x in enumerate(w) if k % 9)
    d = spark.createDataFrame([(1, "antes " * 50 + edited + " depois" * 50), (2, "nada a ver")], "doc_id long, text string")
    (r,) = leaked_passages(d, spark.createDataFrame([(5, text)], "item_id long, text string")).collect()
    assert (r.doc_id, r.item_id, r.longest) == (1, 5, 0)
    assert 0.75 < r.score < 0.95 and r.start_word == 50 and r.end_word == 50 + len(edited.split())


def test_alignment_matches_plain_dynamic_programming(rng):
    pairs, want = [], []
    for _ in range(60):
        a, b = ([2 * rng.randint(0, 5) + 1 for _ in range(rng.randint(1, 25))] for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        pairs.append((np.array(a, np.uint64), np.array(b, np.uint64)))
        want.append(h.max())
    assert align(*map(list, zip(*pairs)))[:, 0].tolist() == want


def test_every_exact_stretch_reaches_the_points_asked_for(spark, rng):
    docs, items = corpus(rng)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = leaked_passages(d, i).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.points >= 24 and r.longest >= 12} == brute(docs, items)
    assert any(r.points < 24 for r in got)


def test_empty(spark):
    d, i = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert leaked_passages(d, i).count() == 0
