import glob

import pytest

from lavra.llm.quality import COMMON, common_words, kind_and_stats, text_quality

CASES = {
    "prose": ["Quando o operador confirma o pedido, a tela é atualizada e o total não confere com a nota.\nDepois da integração, o relatório sai em branco para todos os usuários.", "Hoje não."],
    "list": ["- Turno\n- Série\n- Depósito\n- Validade\n", "Verificar os campos:\nTurno;\nSérie;\nDepósito;\nGrupo Fiscal;\nValidade;", "Turno / Série / FATU12 carga / Depósito / Reabrir lote / Validade"],
    "table": ["a;b;c\n1;2;3\n4;5;6\n7;8;9", "| x | y |\n| 1 | 2 |\n| 3 | 4 |\n| 5 | 6 |", "cod\tnome\tvalor\n1\tabc\t2,5\n2\tdef\t3,5\n3\tghi\t4,5"],
    "junk": ["teste teste " * 40, "wptcwg zkrc rjgv cmxwp zpfxc vbdfq bxfkn rdqft bqqm fbtg cnmrs brlv lfnj", "00000000  3d 5b e7 d9 0e 7f d2 c8 bf 06\n00000010  4d 7d d8 47 bd 63 10 f8 54 cf", "{_{#*<1+^4*]7~-\n^:3|/<#6!]_::54295:328^4#*>#34!4!", "aaa\n" * 50],
}


@pytest.mark.parametrize("kind,text", [(k, t) for k, ts in CASES.items() for t in ts])
def test_kinds(kind, text):
    assert kind_and_stats(text)[0] == kind


def test_statistics():
    kind, words, mean, symbols, lines, ends, common, dup, dup_p, gram = kind_and_stats("O dia é bom.\nO dia é bom.\n\nfim")
    assert (words, lines) == (9, 3) and ends == pytest.approx(2 / 3) and dup == pytest.approx(12 / 27)
    assert dup_p == 0 and 0 < gram < 1 and 0 < symbols < 0.2 and common > 0.3 and mean > 1
    assert kind_and_stats(None) == kind_and_stats("") == kind_and_stats(" \n\t") == (None, 0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_rows(spark):
    rows = [(1, CASES["list"][0], "x"), (1, CASES["list"][0], "x"), (2, None, "x"), (None, "texto de uma linha para ler.", "x"), (3, CASES["prose"][0] * 3000, "x")]
    got = text_quality(spark.createDataFrame(rows, "doc_id long, text string, kind string"))
    assert sorted(map(str, got.select("kind").toPandas()["kind"])) == ["None", "list", "list", "prose", "prose"] or got.count() == 5
    assert text_quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_labelled_sample(spark):
    """The hand-labelled documents, where the test tables are there."""
    if not glob.glob("/root/testdata/sf0.1/quality_labels.parquet"):
        pytest.skip("no test tables")
    d, q = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "quality_labels"))
    rows = text_quality(d.join(q.select("doc_id"), "doc_id", "left_semi")).select("doc_id", "kind").join(q.withColumnRenamed("kind", "label"), "doc_id").collect()
    assert all(r.kind == r.label for r in rows)


def test_common_words_are_counted(spark, rng):
    names = ["fiscal", "carga", "laudo", "amostra", "pedido", "estoque", "contrato", "comissão", "remessa", "turno"]
    prose = [". ".join(f"O operador confirma {rng.choice(names)} no programa e a tela de {rng.choice(names)} mostra {rng.choice(names)}" for _ in range(4)) + "." for _ in range(300)]
    mixed = ["".join(rng.sample(w, len(w))) if len(w) > 2 else w for w in " ".join(prose[:3]).split(" ")]
    docs = [(i, t) for i, t in enumerate(prose)] + [(900, " ".join(mixed)), (901, None), (902, ""), (903, " ".join(w[::-1] for w in prose[5].split(" ")))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    known = common_words(d)
    assert {"operador", "comissão", "programa"} <= known.words and known.least > 0.4 and not {"rodarepo", "o"} & (known.words - COMMON)
    kinds = {r.doc_id: r.kind for r in text_quality(d).collect()}
    assert kinds[900] == kinds[903] == "junk" and kinds[901] is kinds[902] is None and {kinds[i] for i in range(300)} == {"prose"}
    assert common_words(d.limit(0)).words == COMMON
