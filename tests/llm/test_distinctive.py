import unicodedata

import regex

from lavra.llm.distinctive import distinctive_phrases

SCHEMA = "id string, text string, phrases array<string>, weight string"


def fold(s):
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")


def words(s):
    return regex.findall(r"\p{L}+", fold(s))


def brute(rows):
    """(id, phrase) -> (tf, df), by looking at every window of every text."""
    by_id = {}
    for i, text, phrases, _ in rows:
        if i is not None:
            by_id.setdefault(i, (words(text or ""), {tuple(words(p)) for p in phrases or [] if p} - {()}))
    count = lambda w, p: sum(tuple(w[k : k + len(p)]) == p for k in range(len(w)))
    out = {}
    for i, (w, ps) in by_id.items():
        for p in ps:
            if count(w, p):
                out[i, " ".join(p)] = (count(w, p), sum(count(v, p) > 0 for v, _ in by_id.values()))
    return out


def test_counts_match_brute_force(spark, rng):
    vocabulary = ["nota", "fiscal", "saída", "saida", "de", "código", "CÓDIGO", "lote", "x", "estoque"]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", ",", " 12", "\n"]) for _ in range(rng.randint(0, 40)))
        phrases = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 4))]
        rows.append((f"d-{i}", text, phrases, "clash"))
    rows += [rows[3], rows[4], ("n1", None, ["nota"], None), ("n2", "nota nota", None, None), ("n3", "", [], None), (None, "nota", ["nota"], None)]
    rows += [("n4", "a a a a", ["a a", "12", "", None], None), ("n5", "a b a b a Ωμέγα №5", ["a b a", "a-b", "ωμεγα"], None), ("long", "lote estoque " * 20000, ["lote estoque", "estoque lote"], None)]
    got = {(r.id, r.phrase): (r.tf, r.df) for r in distinctive_phrases(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)
    assert got["n4", "a a"] == (3, 1) and got["n5", "a b a"][0] == got["n5", "a b"][0] == 2 and got["n5", "ωμεγα"] == (1, 1)
    assert got["long", "lote estoque"][0] == 20000


def test_common_and_lonely_phrases_fall_behind(spark):
    rows = [(f"c{i}", "geral geral texto de fundo comum a todos " * 2 + ("raro raro " if i < 3 else "") + ("unico unico" if i == 0 else ""), ["geral", "raro", "unico"], None) for i in range(60)]
    r = {x.phrase: x for x in distinctive_phrases(spark.createDataFrame(rows, SCHEMA)).filter("id = 'c0'").collect()}
    assert r["raro"].rank == 1
    assert r["raro"].weight > r["geral"].weight >= 0
    assert r["unico"].weight == 0 and r["unico"].probability > 0


def test_empty(spark):
    assert distinctive_phrases(spark.createDataFrame([], SCHEMA)).count() == 0



def test_cases_stand_before_common_and_lonely_phrases(spark, rng):
    """In every record the phrases that the query reports outrank those found nowhere else and those found all over."""
    rows = []
    for i in range(200):
        rare = f"tema{chr(97 + i % 25)}{chr(97 + i % 2)}"
        rows.append((f"c{i}", f"{rare} x {rare} geral geral comum so{chr(97 + i // 26)}{chr(97 + i % 26)} fim {rare}", [rare, "geral", f"so{chr(97 + i // 26)}{chr(97 + i % 26)}"], None))
    for r in distinctive_phrases(spark.createDataFrame(rows, SCHEMA)).collect():
        case = r.tf >= 2 and 2 <= r.df <= 12
        assert (r.rank == 1) == case or r.df == 1
