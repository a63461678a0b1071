import pytest

from lavra.llm.splitting import Limits, bisect_spans, scan_on, scan_spans, split_topics, transitions

B = " \t\n\r"


def brute(x, size=2400, least=400, overlap=200):
    out, s = [], 0
    while len(x) - s > size:
        r = range(s + size, s + least, -1)
        kinds = (lambda e: x[e - 2 : e] == "\n\n", lambda e: x[e - 1] in B and x[e - 2] in ".!?:;", lambda e: x[e - 1] in B)
        e = next((e for k in kinds for e in r if k(e)), s + size)
        out.append((s, e))
        s = next((p for p in range(e - overlap, e) if x[p - 1] in B), e - overlap)
    return [*out, (s, len(x))]


def text(rng, n, dense=True):
    out = ""
    while len(out) < n:
        out += rng.choice(["palavra", "x", "ç" * 30, "😀"]) + rng.choice([" ", ". ", "\n", "\n\n", "\n\n\n", ";\t", "", "!\r"] if dense else ["", "", " "])
    return out[:n]


def test_scan_matches_brute_force(rng):
    small = Limits(60, 10, 7)
    for k in range(300):
        t = text(rng, rng.randint(0, 900), k % 2 == 0)
        assert scan_spans(t, small) == brute(t, 60, 10, 7)
    for t in ("", "a" * 2400, "a" * 2401, " " * 9000, "\n" * 9000, text(rng, 40000), "b" * 30000):
        assert scan_spans(t) == brute(t)


def test_bisection_covers_within_the_limit(rng):
    for n in (10, 2400, 2401, 9000, 40000):
        t = text(rng, n)
        spans = bisect_spans(t)
        assert spans[0][0] == 0 and spans[-1][1] == len(t)
        assert all(0 < e - s <= 2400 for s, e in spans)
        assert all(b[0] < a[1] and a[1] - b[0] <= 200 for a, b in zip(spans, spans[1:]))


def test_topics(spark, rng):
    long = [text(rng, 1500) for _ in range(5)]
    rows = [("t1", f"1-{i}", i, t, "x") for i, t in enumerate(long)] + [("t1", "1-2", 2, long[2], "y")]
    rows += [("t2", "2-0", 0, "curto", "x"), (None, "3-0", 0, "a" * 5000, "x"), ("t4", "4-0", 0, "a" * 2398, "x"), ("t4", "4-1", 1, None, "x"), ("t5", "5-0", 0, "a" * 2399, "x"), ("t5", "5-1", None, "", "x")]
    rows.reverse()
    df = spark.createDataFrame(rows, "topic_id string, chunk_id string, position int, text string, start_pos string").repartition(5)
    got = {}
    for r in split_topics(df).collect():
        got.setdefault(r.topic_id, {})[r.piece_no] = (r.start_pos, r.end_pos)
    want = {"t1": brute("\n\n".join(long)), "t5": brute("\n\n" + "a" * 2399)}
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == want
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in got.values())
    assert split_topics(df.limit(0)).count() == 0


def test_transitions_match_scans(rng):
    small = Limits(60, 10, 7)
    for k in range(40):
        before, t = text(rng, 60, k % 2 == 0), text(rng, rng.randint(0, 300), k % 2 == 0)
        left, n = transitions(before, t, small)
        for d in range(61):
            spans, rest = scan_on(before[60 - d :], t, small)
            assert (left[d], n[d]) == (rest, len(spans))


@pytest.mark.parametrize("block", [70, 400])
def test_hot_topics_are_split_the_same(spark, rng, block):
    small = Limits(60, 10, 7)
    rows, want = [], {}
    for t in range(6):
        texts = [text(rng, rng.choice([0, 3, 40, 90, 700]), t % 2 == 0) for _ in range(rng.choice([1, 4, 30]))]
        rows += [(f"t{t}", f"{t}-{i:03}", i if i else None, x) for i, x in enumerate(texts)]
        whole = "\n\n".join(texts)
        if len(whole) > 60:
            want[f"t{t}"] = brute(whole, 60, 10, 7)
    df = spark.createDataFrame(rows + rows[::7], "topic_id string, chunk_id string, position int, text string")
    got = {}
    for r in split_topics(df, small, hot=100, block=block).collect():
        assert r.piece_no not in got.setdefault(r.topic_id, {})
        got[r.topic_id][r.piece_no] = (r.start_pos, r.end_pos)
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == want
