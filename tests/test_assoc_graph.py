import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lavra.operators import assoc, describe, graph


def baskets(rng, n=160):
    items = [f"FATU{i}" for i in range(6)] + [f"PEDI{i}" for i in range(5)] + ["#nota", "#frete", "KND-1"]
    return {(f"b{i}", rng.randint(0, 9)): set(rng.sample(items, rng.choice([0, 1, 2, 3, 5]))) for i in range(n)}


def brute_rules(b, min_together=3, min_docs=3, conf=0.2, lift=2.0, tconf=0.03, tlift=3.0, term_term=False):
    n, count, pairs, docs = len(b), {}, {}, {}
    for (_, d), items in b.items():
        for i in items:
            count[i] = count.get(i, 0) + 1
        for p in combinations(sorted(items), 2):
            pairs[p] = pairs.get(p, 0) + 1
            docs.setdefault(p, set()).add(d)
    out = {}
    for (x, y), t in pairs.items():
        if t < min_together or len(docs[x, y]) < min_docs or (x[0] == y[0] == "#" and not term_term):
            continue
        for f, g in ((x, y), (y, x)):
            c, py = t / count[f], count[g] / n
            lo = (tconf, tlift) if f[0] == "#" and g[0] != "#" else (conf, lift)
            if c >= lo[0] and c / py >= lo[1]:
                out[f, g] = (t, len(docs[x, y]), count[f], count[g], c, c / py, (1 - py) / (1 - c) if c < 1 else None)
    return out


def frame(spark, b):
    rows = [(k, d, i, "x") for (k, d), items in b.items() for i in (items or {None})]
    return spark.createDataFrame(rows + rows[:20], "basket string, doc long, item string, a string").repartition(7)


@pytest.mark.parametrize("limits", [{}, {"min_confidence": 0.05, "min_lift": 0.8, "term_lift": 0.5, "term_term": True}])
def test_rules(spark, limits):
    b = baskets(random.Random(2))
    b |= {("one", 1): {"SOLO1", "SOLO2"}, ("two", 2): {"SOLO1", "SOLO2"}, ("three", 3): {"SOLO1", "SOLO2"}}
    short = {"min_confidence": "conf", "min_lift": "lift", "term_lift": "tlift", "term_term": "term_term"}
    want = brute_rules(b, **{short[k]: v for k, v in limits.items()})
    rows = assoc.with_score(assoc.rules(assoc.build_baskets(frame(spark, b)), **limits)).collect()
    got = {(r.from_item, r.to_item): (r.together, r.documents, r.from_baskets, r.to_baskets, r.confidence, r.lift, r.conviction) for r in rows}
    assert got.keys() == want.keys() and ("SOLO1", "SOLO2") in got and got["SOLO1", "SOLO2"][6] is None
    for k, w in want.items():
        assert all(a == b or a == pytest.approx(b) for a, b in zip(got[k], w))
    for r in rows:
        assert 0 < r.confidence <= 1 and r.weight == pytest.approx(r.together / (r.from_baskets + 3), abs=1e-4)
        assert r.score == pytest.approx(r.together / (r.from_baskets + 3) * math.log2(1 + min(round(r.lift + 1e-9, 2), 50)) * math.log2(1 + r.documents), abs=0.02)
        assert "#" not in r.from_item + r.to_item or r.cross_module == 0


def test_oversized_empty_and_units(spark):
    big = {(f"b{i}", i): {f"FATU{k}" for k in range(30)} for i in range(3)} | {("t", 1): {f"#t{k}" for k in range(40)}, ("e", 2): set()}
    kept = assoc.build_baskets(frame(spark, big))
    assert {r.basket for r in kept.collect()} == {"t", "e"}
    assert tuple(assoc.totals(kept).first()) == (2, 2)
    assert assoc.rules(kept.filter("false")).count() == 0
    c = spark.createDataFrame([("1-0", 1, 2, "1-t0", "3"), ("1-1", 1, 2, "1-t1", ""), (None, None, None, None, None)], "chunk_id string, doc_id long, record int, topic_id string, topic_number string")
    assert [r[0] for r in c.select(assoc.basket_key("topic")).collect()] == ["1-t0", "1-r2", "-r"]
    assert [r[0] for r in c.select(assoc.basket_key("document")).collect()] == ["1", "1", None]
    with pytest.raises(ValueError):
        assoc.basket_key("page")


def test_copied_chunks_and_evidence(spark):
    t = "texto igual do começo " * 10
    rows = [("1-0", 1, 0, t, ["A1", "B1"]), ("2-0", 2, 0, t.upper() + "!!", ["A1", "B1"]), ("3-0", 3, 0, t, ["A1"]), ("3-1", 3, 1, t, ["A1"]), ("4-0", 4, 0, "outro", ["A1", "B1"]), ("5-0", 5, 0, None, ["A1", "B1"])]
    c = spark.createDataFrame(rows, "chunk_id string, doc_id long, position int, text string, items array<string>")
    assert {r.chunk_id for r in assoc.drop_copied_chunks(c).collect()} == {"1-0", "3-0", "3-1", "4-0", "5-0"}
    e = [(f"{d}-{p}", f"b{d}", d, (d, p), i) for d in range(5) for p, i in enumerate((["A1"], ["B1"], ["A1", "B1"] if d == 2 else []))]
    chunks = spark.createDataFrame(e, "chunk_id string, basket string, doc long, seq struct<d:int,p:int>, items array<string>")
    r = spark.createDataFrame([("A1", "B1"), ("B1", "A1")], "from_item string, to_item string")
    assert [(x.rank, x.chunk_id) for x in assoc.evidence(chunks, r).orderBy("rank").collect()] == [(1, "0-0"), (2, "1-0"), (3, "2-2")]


def test_result_does_not_depend_on_partitions(spark):
    f = frame(spark, baskets(random.Random(5)))
    one, many = ({tuple(r) for r in assoc.rules(assoc.build_baskets(f.repartition(n)), min_lift=1.0).collect()} for n in (1, 11))
    assert one == many


EDGES = "edge_id long, version string, from_node string, to_node string, relation string, weight double, confidence double, lift double, documents int, cross_module int, score double"


def beam(edges, src, hops, penalty=0.5):
    out = {}
    frontier = {src: (1.0, [src])}
    best = {}
    for a, b, w in edges:
        best[a, b] = max(w, best.get((a, b), 0))
    for a, b in best:
        out.setdefault(a, []).append((b, best[a, b]))
    found = {}
    for h in range(1, hops + 1):
        nxt = {}
        for node, (s, path) in frontier.items():
            for b, w in sorted(out.get(node, []), key=lambda x: (-x[1], x[0]))[:50]:
                if w < 0.05 or b in path:
                    continue
                v = s * w * (penalty if h > 1 else 1)
                key = (-v, path + [b])
                if b not in nxt or key < (-nxt[b][0], nxt[b][1]):
                    nxt[b] = (v, path + [b])
        for b, (v, path) in nxt.items():
            if b not in found or v > found[b][0]:
                found[b] = (v, h, path)
        frontier = {n: x for n, x in nxt.items() if not n.startswith("#")}
    return found


@pytest.mark.parametrize("hops", [1, 2, 3])
def test_walk_matches_a_beam_search(spark, hops):
    rng = random.Random(6)
    nodes = [f"P{i}" for i in range(14)] + ["#nota", "#frete"]
    edges = [(rng.choice(nodes), rng.choice(nodes), rng.choice([0.04, 0.1, 0.2, 0.3, 0.5, 0.9])) for _ in range(90)]
    edges += edges[:5] + [("P0", f"Q{i}", 0.06) for i in range(80)]
    rows = [(i, "v2", a, b, "co", w, w, 3.0, 3, i % 2, w) for i, (a, b, w) in enumerate(edges)] + [(999, "v1", "P0", "OLD", "co", 0.9, 0.9, 3.0, 3, 0, 1.0), (998, "v2", "P1", "NW", "co", None, 0.9, 3.0, 3, 0, 1.0)]
    e = spark.createDataFrame(rows, EDGES)
    n = spark.createDataFrame([("v2", x, "program", x.lower(), "P") for x in {*nodes, *(f"Q{i}" for i in range(80))}] + [("v1", "OLD", "program", None, "O")], "version string, node_id string, node_type string, name string, module string")
    runs = spark.createDataFrame([("v1", "2020"), ("v2", "2021")], "version string, created_at string")
    items = spark.createDataFrame([(" p0",), ("P3",), ("#Nota",), ("zz",), (" ",), (None,)], "item string")
    known, unknown = graph.split_inputs(items, n.filter("version = 'v2'"))
    inputs = {r.item for r in known.collect()}
    assert inputs == {"P0", "P3", "#nota"} and {r.item for r in unknown.collect()} == {"ZZ"}
    want = {(s, b): v for s in inputs for b, v in beam(edges, s, hops).items()}
    paths = graph.best_paths(known, graph.walkable(e.filter("version = 'v2'")), hops)
    got = {(r.src, r.node): r for r in paths.collect()}
    assert got.keys() == want.keys()
    for k, (v, h, path) in want.items():
        assert got[k].strength == pytest.approx(v) and got[k].path == path and got[k].hops == h and len(got[k].steps) == h
    score = {}
    for (s, b), (v, h, _) in want.items():
        if b not in inputs and not b.startswith("#"):
            score[b] = 1 - (1 - score.get(b, 0)) * (1 - v)
    ranked = graph.find_impact_candidates(runs, n, e, items, max_hops=hops, limit=10_000)
    rows = {r.node: r for r in ranked.collect()}
    assert {b: pytest.approx(v) for b, v in score.items() if v >= 0.02} == {b: r.score for b, r in rows.items()}
    assert "OLD" not in rows and all(r.score >= max(p.strength for p in r.paths) - 1e-4 for r in rows.values())
    assert graph.find_impact_candidates(runs, n, e, items.filter("item = 'zz'")).count() == 0
    if hops == 2:
        top = graph.rank_candidates(graph.combine(paths, known), limit=3)
        ev = spark.createDataFrame([(i, r, f"c{r}") for i in range(200) for r in (2, 1, 3)], "edge_id long, rank int, chunk_id string")
        ch = spark.createDataFrame([(f"c{r}", "d", "t", "") for r in (1, 2, 3)], "chunk_id string, doc_name string, title string, pedido string")
        for r in graph.explain(top, n.filter("version = 'v2'"), ev, ch).collect():
            assert r.name == r.node.lower() and [x.chunk_id for x in r.evidence] == ["c1", "c2"]


def test_recommend_and_views(spark):
    e = spark.createDataFrame([(1, "v", "A", "X", "co", 0.5, 0.5, 3.0, 2, 1, 2.0), (2, "v", "B", "X", "co", 0.5, 1.0, 3.0, 2, 0, 3.0), (3, "v", "A", "B", "co", 0.5, 0.9, 3.0, 2, 0, 1.0), (4, "v", "A", "Y", "co", 0.5, 0.9, 1.0, 2, 0, 9.0)], EDGES)
    got = {r.node: r.score for r in graph.recommend_by_confidence(e, spark.createDataFrame([("a",), ("b",)], "item string")).collect()}
    assert got == {"X": 1.0}
    assert [r.edge_id for r in graph.overview(e).collect()] == [2, 1, 3]
    n = spark.createDataFrame([("v", "A", "na", "M"), ("v", "X", "nx", "N")], "version string, node_id string, name string, module string")
    ev = spark.createDataFrame([(1, 2, "c2"), (1, 1, "c1")], "edge_id long, rank int, chunk_id string")
    r = {x.edge_id: (x.from_name, x.to_name, x.to_module, x.evidence) for x in graph.edge_full(e, n, ev).collect()}
    assert r[1] == ("na", "nx", "N", "c1 c2") and r[3] == ("na", None, None, None)
    assert graph.referenced_chunks(spark.createDataFrame([("c1",), ("c9",)], "chunk_id string"), ev).count() == 1
    assert graph.latest_version(spark.createDataFrame([], "version string, created_at string")).count() == 0


def test_descriptions(spark):
    chunks = spark.createDataFrame([(i, "FATU1 FATU2", ["nota fiscal", "raro"] if i else ["nota fiscal"], "Manual.PDF") for i in range(2)] + [(9, None, None, None)], "seq int, main_programs string, key_phrases array<string>, doc_name string")
    d = describe.describe_programs(
        spark.createDataFrame([("FATU1",), ("FATU9",)], "code string"), chunks, spark.createDataFrame([("FATU1", "Emissão")], "code string, name string"),
        spark.createDataFrame([("FATU1", ["frete"])], "code string, terms array<string>"),
        spark.createDataFrame([("FATU1", "Cadastro", "Programa", ["Outro"], 3)], "code string, name string, type string, variants array<string>, entries int"),
        spark.createDataFrame([("FATU1", "Texto da equipe.")], "program string, description string"),
    )
    r = {x.code: x for x in d.collect()}
    assert r["FATU1"].description == "FATU1 – Cadastro. Tipo: Programa. Texto da equipe. Nos documentos também aparece como: Emissão. Variações no menu: Outro. Assuntos: frete. Termos frequentes: nota fiscal. Documentos: Manual."
    assert r["FATU9"].description == "FATU9." and r["FATU1"].menu_entries == 3


def test_kinds(spark):
    t = spark.createDataFrame([("#x",), ("KND-1",), ("FATU1",)], "i string").select(assoc.kind_of(F.col("i")), assoc.module_of_item(F.col("i")))
    assert [tuple(r) for r in t.collect()] == [("term", "#"), ("message", "KND"), ("program", "FATU")]
