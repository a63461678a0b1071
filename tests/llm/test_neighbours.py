import numpy as np
import pyarrow as pa

from lavra.llm import neighbours as N

DIMS = 192


def rows_of(v):
    return [(f"{i}", [float(x) for x in r]) for i, r in enumerate(v)]


def brute(v, k):
    s = v @ v.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, 1)[:, :k]


def clustered(n=900, groups=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, DIMS))
    v = centres[rng.integers(0, groups, n)] + 0.5 * rng.standard_normal((n, DIMS))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def test_validity(spark):
    one = [1.0] + [0.0] * (DIMS - 1)
    rows = [("a", one), ("a", one), ("b", [3.0] * DIMS), ("zero", [0.0] * DIMS), ("nan", [float("nan")] * DIMS), ("inf", [float("inf")] + [0.0] * (DIMS - 1)),
            ("short", [1.0] * 10), ("empty", []), ("null", None), (None, one), ("unknown", one), ("gap", [None] + [1.0] * (DIMS - 1))]
    known = spark.createDataFrame([(i,) for i in ("a", "a", "b", "zero", "nan", "inf", "short", "empty", "null", "gap", "novec", None)], "id string")
    got = N.valid_vectors(spark.createDataFrame(rows, "id string, vector array<float>"), known).collect()
    assert sorted(r.id for r in got) == ["a", "b"]


def test_recall_against_brute_force(spark):
    v = clustered()
    df = N.valid_vectors(spark.createDataFrame(rows_of(v), "id string, vector array<float>"), spark.createDataFrame([(str(i),) for i in range(len(v))], "id string"))
    got = {}
    for r in N.nearest_vectors(df, N.Plan(per_pivot=100)).collect():
        got.setdefault(int(r.id), {})[r.rank] = int(r.neighbour)
    want = brute(v, 5)
    assert all(sorted(g) == [1, 2, 3, 4, 5] and len(set(g.values())) == 5 and i not in g.values() for i, g in got.items())
    assert np.mean([len(set(got[i].values()) & set(want[i])) / 5 for i in range(len(v))]) >= 0.9


def test_near_pairs_and_copies(spark):
    rng = np.random.default_rng(9)
    v = clustered(400)
    near = v[:30] + 0.15 * rng.standard_normal((30, DIMS)) / np.sqrt(DIMS)
    v = np.concatenate((v, near, v[50:52], v[50:51]))
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    df = N.valid_vectors(spark.createDataFrame(rows_of(v), "id string, vector array<float>"), spark.createDataFrame([(str(i),) for i in range(len(v))], "id string"))
    got = {tuple(sorted((int(r.a), int(r.b)))) for r in N.mutual_pairs(N.nearest_vectors(df), 0.95).collect()}
    assert got == {(i, 400 + i) for i in range(30)} | {(50, 430), (51, 431), (50, 432), (430, 432)}


def test_big_cell_of_copies_is_searched():
    plan = N.Plan(cell=1500, wide=5)
    v = np.tile(np.eye(1, DIMS, dtype=np.float32), (plan.cell + 500, 1))
    assert (N.search_members(v, plan)[1][:, :5] > 0.999).all()


def test_search_of_a_cell_against_brute_force():
    rng = np.random.default_rng(4)
    near = clustered(4000, 100)
    v = np.concatenate((near, rng.standard_normal((500, DIMS)).astype(np.float32)))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    at, sim = N.search_members(v, N.Plan())
    want = brute(v, 5)
    found = [len(set(a[:5].tolist()) & set(w.tolist())) / 5 for a, w in zip(at, want)]
    assert np.mean(found[4000:]) == 1 and np.mean(found[:4000]) > 0.97
    parts, _ = N.search_members(v, N.Plan(cell=2000))
    assert np.mean([len(set(a[:5].tolist()) & set(w.tolist())) / 5 for a, w in zip(parts, want)]) > 0.9


def test_queries_without_near_vectors_go_on_to_wide_cells(spark):
    rng = np.random.default_rng(12)
    v = np.concatenate((clustered(600), rng.standard_normal((300, DIMS)))).astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = N.valid_vectors(spark.createDataFrame(rows_of(v), "id string, vector array<float>"), spark.createDataFrame([(str(i),) for i in range(len(v))], "id string"))
    got = {}
    for r in N.nearest_vectors(df, N.Plan(per_pivot=20, probes=1, far_pivot=300, far_probes=3)).collect():
        got.setdefault(int(r.id), set()).add(int(r.neighbour))
    want = brute(v, 5)
    assert all(i not in got[i] and len(got[i]) == 5 for i in range(600, 900))
    assert np.mean([len(got[i] & set(want[i])) / 5 for i in range(600, 900)]) >= 0.99


def test_few_and_none(spark):
    df = N.valid_vectors(spark.createDataFrame([("a", [1.0] * DIMS), ("b", [1.0, -1.0] * (DIMS // 2))], "id string, vector array<float>"), spark.createDataFrame([("a",), ("b",)], "id string"))
    assert {(r.id, r.neighbour) for r in N.nearest_vectors(df).collect()} == {("a", "b"), ("b", "a")}
    assert N.nearest_vectors(df.filter("false")).count() == 0


def test_matrix_of_sliced_columns():
    a = pa.array([[3.0, 4.0], [1.0, 0.0], [0.0, 2.0]], pa.list_(pa.float32()))
    assert N.matrix(a.slice(1), 2).tolist() == [[1.0, 0.0], [0.0, 1.0]]


def test_many_copies_go_by_id(spark):
    v = clustered(300)
    near = v[0] + 0.1 * v[1]
    v = np.concatenate((v, np.repeat(v[:1], 40, axis=0), np.repeat((near / np.linalg.norm(near))[None], 20, axis=0)))
    ids = [f"{i:03d}" for i in np.random.default_rng(2).permutation(len(v))]
    rows = [(i, [float(x) for x in r]) for i, r in zip(ids, v)]
    df = N.valid_vectors(spark.createDataFrame(rows, "id string, vector array<float>"), spark.createDataFrame([(i,) for i in ids], "id string"))
    got = {}
    for r in N.nearest_vectors(df).orderBy("rank").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    first, second = sorted([ids[0], *ids[300:340]]), sorted(ids[340:])
    for group in (first, second):
        assert all(got[i] == [j for j in group if j != i][:5] for i in group)
    assert len(got) == len(v) and all(len(set(g)) == 5 and i not in g for i, g in got.items())
    pairs = {(r.a, r.b) for r in N.mutual_pairs(N.nearest_vectors(df), 0.95).collect()}
    assert {(a, b) for a in first[:6] for b in first[:6] if a < b} <= pairs
