import random

from pyspark.sql import functions as F

from lavra.llm.email import compression_gain, is_email, new_lines, newly_written

QUOTED_BELOW = """De: Ana Lima <ana@x.example>
Enviada em: 01/02/2020 10:00
Para: Rui Melo
Assunto: RE: ajuste

Bom dia,

Enviado ontem o arquivo, porém o total não confere.
-> verificar o campo Para o caminho Cadastros > Produtos.

Att,
Ana Lima
Compras
Fone (00) 1234-5678

Esta mensagem pode conter informação confidencial e destina-se apenas ao seu destinatário.

Em 31/01/2020 09:00,
Rui Melo escreveu:
> Segue o pedido.
>
> > Em 30/01/2020 08:00, Ana Lima escreveu:
> > antigo
| outra barra

Obs.: volto amanhã."""


def test_styles():
    assert new_lines(QUOTED_BELOW) == [6, 8, 9, 26]
    forwarded = "Segue abaixo.\n\n---------- Mensagem encaminhada ----------\nDe: A B\nEnviada em: 1\nPara: C D\n\nTexto velho\n\nPS: fim"
    assert new_lines(forwarded) == [1, 10]
    bare = "Tudo certo.\nAna Lima\nAnalista de Suporte\n\n________________________________\nDe: A B\nEnviada em: 1\nPara: C D\nvelho"
    assert new_lines(bare) == [1]
    inter = "Em 01/01/2020 10:00, A B escreveu:\n> pergunta um\nresposta um\n> pergunta dois\nresposta dois\n-- \nC D"
    assert new_lines(inter) == [3, 5]
    assert new_lines("Hi Ana\nPara resumir: está pronto.\r\nA pessoa escreveu: nada mudou.\r\n \t\r\nAtt. ao prazo: amanhã.") == [1, 2, 3, 5]
    assert new_lines("E-mail — Assunto: x\nOlá!\nCódigo Reduzido.") == [2, 3]


def test_unmarked_copy_of_an_ancestor_is_removed():
    old = "O relatório agrupa carga por Natureza e soma a coluna Situação da grade."
    t = f"Novo comentário sobre o assunto.\n\n{old}\n\nEm 01/01/2020 10:00, A B escreveu:\n> {old}\n> fim"
    assert new_lines(t) == [1]
    assert compression_gain(old, old.encode()) > 0.8 > compression_gain("Algo bem diferente, sem relação.", old.encode())


def test_edge_cases():
    assert new_lines(None) == [] and new_lines("") == [] and new_lines(" \n\t\n") == []
    assert new_lines("linha comum de texto sem marca.\n" * 20000)[-1] == 20000


def test_rows(spark):
    c = spark.createDataFrame([("a", QUOTED_BELOW, "E-mail"), ("a", QUOTED_BELOW, "EMAIL "), ("b", None, "email"), ("c", "Oi", None), ("d", "Oi", "pedido")], "id string, text string, record_type string")
    assert [r[0] for r in c.filter(is_email(F.col("record_type"))).select("id").collect()] == ["a", "a", "b"]
    got = sorted((r.id, r.line_no) for r in newly_written(c.filter(is_email(F.col("record_type")))).collect())
    assert got == [("a", 6), ("a", 8), ("a", 9), ("a", 26)]
    assert newly_written(c.filter("false")).count() == 0


def test_unmarked_copy_of_an_earlier_email_of_the_thread(spark):
    old = "Bom dia,\n\nO relatório agrupa carga por Natureza e soma a coluna Situação da grade.\nCampo novo: sim\nA conferência do fechamento mensal depende do cadastro de filiais revisado."
    reply = f"Resposta nova sobre outro assunto ainda não tratado.\n\n{old}"
    rows = [("b", reply, "1:1", 2), ("a", old, "1:1", 1), ("c", reply, "1:2", 3), ("d", reply, None, 4)]
    got = {}
    for r in newly_written(spark.createDataFrame(rows, "id string, text string, thread string, position int")).collect():
        got.setdefault(r.id, []).append(r.line_no)
    whole = [1, 3, 5, 6, 7]
    assert {k: sorted(v) for k, v in got.items()} == {"a": [1, 3, 4, 5], "b": [1], "c": whole, "d": whole}


def test_far_ancestors_and_many_closings(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    said = [" ".join(word() for _ in range(7)) for _ in range(800)]
    text = f"Comentário novo.\n\n{said[0]}\n{said[1]}\n\nEm 01/01/2020 10:00, A B escreveu:\n" + "\n".join(f"> {s}" for s in said)
    assert len(text) > 50_000 and new_lines(text) == [1]
    # 2,100 closings, each of six e-mails; the same lines before the text's end go too
    closing = [f"Analista {word()} {word()} {word()}" for _ in range(2100)]
    mails = [(f"{i}-{k}", f"Linha {word()} {word()}.\n\nAtt,\n{c}" if k else f"Linha {word()}.\n\n{c}\n\nFim {word()} do texto.") for i, c in enumerate(closing) for k in range(7)]
    got = newly_written(spark.createDataFrame(mails, "id string, text string")).filter("id like '%-0'").groupBy("id").count().filter("count <> 2").count()
    assert got == 0
