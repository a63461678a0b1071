import json

import pytest
from pyspark.sql import functions as F

from lavra.functions import text as T
from lavra.operators import menu
from lavra.sources import models, readers, sinks

ROWS = [
    ("FATU15", "06 - Emissão de Notas Brisa", "Programa"), ("FATU15_MAX", "Emissão de Notas Max", "Programa"), ("fatu15_brisa", "** novo ** Emissão de Notas", "Relatório"), ("FATU15", "Outra coisa", ""),
    ("PEDI6", "Pedidos", None), ("X1", "fora", None), (None, "sem código", None), ("", "vazio", None), ("COMP1", "Um", "Programa"), ("COMP1", "Dois", "Programa"), ("COMP2", None, "Programa"),
]


def check(entries):
    got = {r.code: r for r in menu.menu_catalogue(entries).collect()}
    assert set(got) == {"FATU15", "PEDI6", "COMP1"}
    f = got["FATU15"]
    assert (f.name, f.type, f.entries, f.customised) == ("Emissão de Notas", "Programa", 4, ["FATU15_BRISA", "FATU15_MAX"])
    assert f.variants == ["Emissão de Notas Brisa", "Emissão de Notas Max", "Outra coisa"]
    assert (got["PEDI6"].name, got["PEDI6"].type, got["PEDI6"].variants) == ("Pedidos", None, [])
    assert got["COMP1"].name == "Um" and got["COMP1"].variants == ["Dois"]


def test_catalogue(spark):
    check(spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "code string, label string, type string, seq long"))
    assert menu.menu_catalogue(spark.createDataFrame([], "code string, label string, type string, seq long")).count() == 0


@pytest.mark.parametrize("encoding,sep,head", [("utf-8-sig", ";", "PROGRAMA;DESCRICAO;TIPO"), ("latin-1", ",", "Programa,Descrição,Tipo"), ("utf-8", ";", "a;b;tipo")])
def test_menu_file(spark, tmp_path, encoding, sep, head):
    p = tmp_path / "menu.csv"
    p.write_bytes("\n".join([head, *(sep.join(x or "" for x in r) for r in ROWS)]).encode(encoding))
    check(menu.read_menu(spark, f"file://{p}"))


@pytest.mark.parametrize("raw,want", [("06 - Fab - Monitor", "Fab - Monitor"), ("12) 3. *** x *** Nome -", "Nome"), ("- – Nome", "Nome"), (None, ""), ("2024 Nome", "2024 Nome"), (" \xa0a\t b ", "a b")])
def test_labels(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "l string").select(T.clean_label(F.col("l"))).first()[0] == want


def test_text_functions(spark):
    one = lambda c, t: spark.createDataFrame([(t,)], "t string").select(c(F.col("t"))).first()[0]
    assert one(T.codes, "FATU12 XXXX1 PEDI4 FATU12 ABFATU1") == ["FATU12", "PEDI4"] and one(T.codes, None) == []
    assert one(T.shorten, "  a   b . ") == "a b" and one(T.shorten, "palavra " * 20) == ("palavra " * 11).strip() + "…" and one(T.shorten, "x" * 100) == "x" * 90 + "…"
    assert one(T.heading, "(...)\nDe: x\nTítulo do texto\nresto") == "Título do texto" and one(T.heading, "Frase com ponto.") == "" and one(T.heading, None) == ""
    assert one(T.fields, "campo Turno, aba Fiscal Geral e campo turno; botão \"Valor Líquido\"") == ["Turno", "Fiscal Geral", "Valor Líquido"]
    assert one(T.email_subject, "x\nE-mail — Assunto: RE: FW: Olá\ny") == "Olá" and one(T.email_subject, "sem") == ""
    assert one(T.messages, "KND- 12 ORA-1 KND-12") == ["KND-12", "ORA-1"] and one(T.code_tables, "[Código: B A] [Código: A]") == ["A", "B"]
    assert one(T.normalize_item, " #Nota ") == "#nota" and one(T.normalize_item, "fatu1") == "FATU1" and one(T.clean_name, "Abrir o programa Cadastro -") == "Cadastro"
    assert one(T.module_of_programs, "FATU1 FATU2") == "FATU" and one(T.module_of_programs, "FATU1 PEDI2") == "" and one(T.module_of_programs, None) == ""
    assert one(T.looks_like_code, "v_a := 1") and one(T.looks_like_code, "AND x = 1") and not one(T.looks_like_code, "o usuário abre a tela") and one(T.looks_like_prose, "este texto tem cinco palavras certas")


def test_round_trips(spark, tmp_path):
    d = f"file://{tmp_path}"
    (tmp_path / "export.json").write_text(json.dumps([{"name": "a.pdf", "text": "x\ny"}, {"name": None, "text": None}]), encoding="utf-8")
    assert [tuple(r) for r in readers.read_export(spark, f"{d}/export.json").orderBy("doc_id").collect()] == [(0, "a.pdf", "x\ny"), (1, None, None)]
    (tmp_path / "terms.txt").write_text("# c\n\nnota fiscal: nf, nf-e*\nsem dois pontos\n", encoding="utf-8")
    assert sorted(tuple(r) for r in readers.read_terms(spark, f"{d}/terms.txt").collect()) == [("nota fiscal", "nf"), ("nota fiscal", "nf-e*"), ("nota fiscal", "nota fiscal")]
    (tmp_path / "desc.csv").write_text("﻿program;description\nfatu1;um\nFATU1;dois\npedi2;\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_descriptions(spark, f"{d}/desc.csv").collect()] == [("FATU1", "dois")]
    chunks = spark.createDataFrame([("1-0", 1, "t\n\"q\"", ["a"], None)], "chunk_id string, doc_id long, text string, key_phrases array<string>, title string")
    sinks.write_jsonl(chunks, f"{d}/chunks")
    r = readers.read_chunks(spark, f"{d}/chunks").first()
    assert (r.chunk_id, r.text, r.key_phrases, r.title, r.pedido) == ("1-0", 't\n"q"', ["a"], None, None)


def test_graph_versions_and_schema_evolution(spark, tmp_path):
    p = f"file://{tmp_path}/graph"
    node = lambda *r: spark.createDataFrame(r, "node_id string, baskets int")
    sinks.save_run({"node": node(("A", 1), ("B", 2))}, p, "v1")
    sinks.save_run({"node": node(("C", 3)).withColumn("menu_name", F.lit("m"))}, p, "v2")
    sinks.save_run({"node": node(("A", 9))}, p, "v1")
    got = {(r.version, r.node_id, r.baskets, r.menu_name) for r in readers.read_graph(spark, p, "node").collect()}
    assert got == {("v1", "A", 9, None), ("v2", "C", 3, "m")}
    assert readers.read_graph(spark, p, "node", "v2").count() == 1


def test_reports(spark, tmp_path):
    r = spark.createDataFrame([("A", "B", 3, 3, 3, 9, 1.0, 2.004, None, 0, "program->program", 1.5)], "from_item string, to_item string, together int, documents int, from_baskets int, to_baskets int, confidence double, lift double, conviction double, cross_module int, kind string, score double")
    sinks.write_rules(r, f"file://{tmp_path}/rules")
    (f,) = tmp_path.glob("rules/*.csv")
    assert f.read_text().splitlines() == ["from,to,together,documents,from_baskets,to_baskets,confidence,lift,conviction,cross_module,kind,score", "A,B,3,3,3,9,1.0,2.0,inf,0,program->program,1.5"]
    sinks.write_duplicates(spark.createDataFrame([(2, 1)], "dropped long, kept long"), spark.createDataFrame([(1, 'a "x"'), (2, "b")], "doc_id long, name string"), f"file://{tmp_path}/dup")
    (f,) = tmp_path.glob("dup/*.csv")
    assert f.read_text().splitlines() == ["dropped_doc_id;dropped_doc;kept_doc_id;kept_doc", '2;b;1;a "x"']
    sinks.write_description_template(spark.createDataFrame([("A", "é")], "program string, description string"), f"file://{tmp_path}/tpl")
    (f,) = tmp_path.glob("tpl/*.csv")
    assert f.read_text(encoding="utf-8").startswith("﻿program;description")
    assert "</" not in sinks.payload(spark.createDataFrame([("</script>",)], "x string"))
    assert "title" in sinks.report([("title", r.select("score"))])
    v = spark.createDataFrame([("a", "h", [1.0, 2.0])], "chunk_id string, hash string, vec array<double>")
    assert sinks.save_vectors(v, f"file://{tmp_path}/vec", 2) == 1 and readers.read_vectors(spark, f"file://{tmp_path}/vec").count() == 1
    with pytest.raises(ValueError):
        sinks.save_vectors(v, f"file://{tmp_path}/vec", 3)


def test_models(tmp_path):
    with pytest.raises(FileNotFoundError):
        models.find_model("no/model", "m.onnx", str(tmp_path))
    m = tmp_path / "org--model"
    (m / "onnx").mkdir(parents=True)
    (m / "onnx" / "m.onnx").write_bytes(b"")
    assert models.find_model("org/model", "onnx/m.onnx", str(tmp_path)) == m and models.pooling_of(m) is None
    with pytest.raises(FileNotFoundError, match="onnx/m.onnx"):
        models.find_model("org/model", "other.onnx", str(tmp_path))
    (m / "1_Pooling").mkdir()
    (m / "1_Pooling" / "config.json").write_text('{"pooling_mode_cls_token": true, "pooling_mode_mean_tokens": true}')
    assert models.pooling_of(m) == "cls"
