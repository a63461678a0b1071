import json

from lavra import cli
from lavra.operators.vectors import hashing_encoder
from lavra.plans import catalogue
from lavra.sources import readers
from lavra.streaming.incremental import embed_stream


def test_contract():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_does_not_import_the_optional_subpackage():
    import pathlib

    root = pathlib.Path(cli.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "lavra.llm" not in p.read_text(encoding="utf-8"), p


def test_stream_encodes_only_new_texts(spark, tmp_path):
    inbox, store = tmp_path / "in", tmp_path / "store"
    inbox.mkdir()
    schema = "chunk_id string, text string"
    made = []

    def encoder():
        made.append(1)
        return hashing_encoder(8)

    def deliver(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{inbox}/{name}")
        q = embed_stream(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"file://{inbox}"), f"file://{store}", f"file://{tmp_path}/cp", encoder)
        q.awaitTermination()

    deliver("a", [("1", "nota fiscal"), ("2", "frete"), ("2", "frete"), ("3", None)])
    deliver("b", [("4", "nota fiscal"), ("5", "novo")])
    got = spark.read.parquet(f"file://{store}")
    assert {r.chunk_id for r in got.collect()} == {"1", "2", "4", "5"}
    v = {r.chunk_id: list(r.vec) for r in got.collect()}
    assert v["1"] == v["4"] and got.filter("batch = 1").count() == 2


def test_command_line_end_to_end(spark, tmp_path, capsys):
    record = "Pedido Serviço: {n} Solicitação: ajustar a rotina de notas\nAbrir o programa FATU{a} e depois o PEDI{b} para conferir a nota fiscal de saída do cliente número {n} com atenção.\n\n"
    docs = [{"name": f"Manual {i}.pdf", "text": "".join(record.format(n=100 * i + k, a=k % 3, b=k % 3) for k in range(6))} for i in range(5)]
    (tmp_path / "export.json").write_text(json.dumps(docs), encoding="utf-8")
    out = f"file://{tmp_path}/out"
    cli.main(["chunk", f"file://{tmp_path}/export.json", "--out", out, "--keep-duplicates"])
    cli.main(["title", f"{out}/chunks", "--out", f"{out}/titled"])
    assert readers.read_chunks(spark, f"{out}/titled").filter("title like '%ajustar a rotina%'").count() == 30
    cli.main(["rules", f"{out}/titled", "--out", out, "--run", "r1", "--min-lift", "1.5"])
    edges = readers.read_graph(spark, f"{out}/graph", "edge")
    assert {(r.from_node, r.to_node) for r in edges.collect()} >= {("FATU1", "PEDI1"), ("PEDI2", "FATU2")}
    assert readers.read_graph(spark, f"{out}/graph", "edge_evidence").groupBy("edge_id").count().filter("count > 3").count() == 0
    capsys.readouterr()
    cli.main(["impact", f"{out}/graph", "fatu1", "nada9"])
    got = json.loads(capsys.readouterr().out)
    assert got[0]["node"] == "PEDI1" and got[0]["paths"][0]["path"] == ["FATU1", "PEDI1"]
    cli.main(["impact", f"{out}/graph", "--runs"])
    assert "r1" in capsys.readouterr().out
    cli.main(["embed", f"{out}/titled", "--out", f"{out}/vectors"])
    assert "30 vectors, 30 of them new" in capsys.readouterr().out
    cli.main(["embed", f"{out}/titled", "--out", f"{out}/vectors"])
    assert "30 vectors, 0 of them new" in capsys.readouterr().out
    cli.main(["search", f"{out}/vectors", "nota fiscal de saída", "--chunks", f"{out}/titled", "-k", "3"])
    got = json.loads(capsys.readouterr().out)
    assert len(got) == 3 and got[0]["score"] >= got[2]["score"] and got[0]["title"]
    readers.read_chunks(spark, f"{out}/titled").selectExpr("chunk_id", "cast(position % 2 as int) as cluster").write.parquet(f"{out}/made")
    cli.main(["audit", f"{out}/titled", f"{out}/vectors", f"{out}/made", "--out", f"{out}/audit", "--least", "0.1"])
    assert capsys.readouterr().out.count("\n\n") >= 5
    rows = {n: spark.read.option("header", "true").csv(f"{out}/audit/{n}").count() for n in ("chunk_links", "cluster_summary", "cluster_links", "clusters")}
    assert rows["cluster_summary"] == 2 and rows["cluster_links"] == 1 and rows["clusters"] == 30 and rows["chunk_links"] == 150
