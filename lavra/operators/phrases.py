"""Key phrases by TF-IDF, learnt program names and titles of chunks.

Rows are chunks with ``chunk_id``; an order column ``seq`` breaks ties by first appearance. Null
texts have no phrase. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lavra.functions import patterns as P
from lavra.functions import text as T
from lavra.session import staged

# What a word of a phrase is, and where phrases end.
_WORD = r"[A-Za-zÀ-ú]+(?:-[A-Za-zÀ-ú]+)*"
_PHRASE_END = r"[.;:!?\n()\"“”*•]"
_STOP = P.PHRASE_STOP.split()
_DULL = sorted({*P.PHRASE_STOP.split(), *P.PHRASE_BOILERPLATE.split()})


def candidates(text: Column, names: Sequence[str] = ()) -> Column:
    """All phrases of 1-3 words inside punctuation, in lower case, repeats kept; ``names`` (of firms, people) are boilerplate as well.

    The first and last word must be usable (three letters or more, neither stop nor boilerplate);
    a middle word may also be a stop word.
    """
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), P.MARKER, " ")
    clean = F.regexp_replace(clean, rf"\b(?:{'|'.join(P.MODULES)})\d{{1,4}}\b", " ")
    segments = F.transform(F.split(clean, _PHRASE_END), lambda s: F.transform(F.regexp_extract_all(s, F.lit(_WORD), F.lit(0)), F.lower))
    # each word is marked once: 2 usable, 1 stop word, 0 neither
    mark = lambda w: F.when((F.length(w) > 2) & ~w.isin(*_DULL, *names), 2).when(w.isin(*_STOP), 1).otherwise(0)
    marked = F.transform(segments, lambda ws: F.transform(ws, lambda w: F.struct(w.alias("w"), mark(w).alias("m"))))
    word = lambda ws, i: F.get(ws, i)["w"]
    ok = lambda ws, i, least: F.get(ws, i)["m"] >= least

    def of(ws: Column) -> Column:
        at = F.when(F.size(ws) > 0, F.sequence(F.lit(0), F.size(ws) - 1)).otherwise(F.array().cast("array<int>"))
        one = F.transform(at, lambda i: F.when(ok(ws, i, 2), word(ws, i)))
        two = F.transform(at, lambda i: F.when(ok(ws, i, 2) & ok(ws, i + 1, 2), F.concat_ws(" ", word(ws, i), word(ws, i + 1))))
        three = F.transform(at, lambda i: F.when(ok(ws, i, 2) & ok(ws, i + 1, 1) & ok(ws, i + 2, 2), F.concat_ws(" ", word(ws, i), word(ws, i + 1), word(ws, i + 2))))
        return F.filter(F.concat(one, two, three), lambda p: p.isNotNull())

    return F.flatten(F.transform(marked, of))


def phrase_counts(chunks: DataFrame, names: Sequence[str] = ()) -> DataFrame:
    """(chunk_id, phrase, tf)."""
    return chunks.select("chunk_id", F.explode(candidates(F.col("text"), names)).alias("phrase")).groupBy("chunk_id", "phrase").agg(F.count(F.lit(1)).alias("tf"))


def phrase_scores(chunks: DataFrame, max_share: float = 0.15, names: Sequence[str] = ()) -> DataFrame:
    """(chunk_id, phrase, tf, df, score) of phrases in 2 chunks or more and at most a share of all."""
    tf = phrase_counts(chunks, names)
    n = chunks.agg(F.countDistinct("chunk_id").alias("n"))
    df = tf.groupBy("phrase").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).filter((F.col("df") >= 2) & (F.col("df") <= F.col("n") * max_share))
    words = F.size(F.split("phrase", " "))
    score = (1 + F.log("tf")) * F.log(F.col("n") / F.col("df")) * (1 + 0.5 * (words - 1))
    return tf.join(df, "phrase").select("chunk_id", "phrase", "tf", "df", score.alias("score"))


def pick_apart(ranked: Column, k: int) -> Column:
    """The first k phrases of an array that share no word with an earlier pick."""
    words = lambda p: F.split(p, " ")
    free = lambda acc, p: ~F.exists(acc, lambda q: F.arrays_overlap(words(q), words(p)))
    add = lambda acc, p: F.when((F.size(acc) < k) & free(acc, p), F.concat(acc, F.array(p))).otherwise(acc)
    return F.aggregate(ranked, F.array().cast("array<string>"), add)


def key_phrases(chunks: DataFrame, k: int = 5, names: Sequence[str] = ()) -> DataFrame:
    """(chunk_id, key_phrases): best score first, equal scores by phrase descending, no shared words."""
    s = phrase_scores(chunks, names=names).groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("score", "phrase")), asc=False).alias("s"))
    return s.select("chunk_id", pick_apart(F.transform("s", lambda x: x["phrase"]), k).alias("key_phrases"))


# How names stand beside program codes.
_UP = "A-ZÁÉÍÓÚÂÊÔÃÕÇ"
_MOD = "|".join(P.MODULES)
NAME_BEFORE = rf"([{_UP}][\p{{L}}\p{{N}}_/ ]{{3,50}}?)\s?[-–]\s?((?:{_MOD})\d{{1,4}})\b"
NAME_AFTER = rf"\b((?:{_MOD})\d{{1,4}})\s?[-–]\s?([{_UP}][\p{{L}}\p{{N}}_/ ]{{3,50}})"


def name_mentions(chunks: DataFrame) -> DataFrame:
    """(code, name, seq) of every "Name-CODE" and "CODE - Name"."""
    parts = []
    for pattern, code, name in ((NAME_BEFORE, 2, 1), (NAME_AFTER, 1, 2)):
        got = lambda g: F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(?U)" + pattern), F.lit(g))  # noqa: E731, B023
        parts.append(chunks.select("seq", F.explode(F.arrays_zip(got(code).alias("code"), got(name).alias("name"))).alias("z")).select("z.code", "z.name", "seq"))
    return parts[0].unionByName(parts[1])


def learnt_names(chunks: DataFrame) -> DataFrame:
    """(code, name): the most frequent cleaned name of 4-45 characters, not all capitals, seen twice or the only one."""
    m = name_mentions(chunks).withColumn("name", T.clean_name(F.col("name")))
    capitals = (F.upper("name") == F.col("name")) & (F.lower("name") != F.col("name"))
    n = m.filter(F.length("name").between(4, 45) & ~capitals).groupBy("code", "name").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    best = n.groupBy("code").agg(F.min(F.struct((-F.col("n")).alias("d"), "first", "name")).alias("b"), F.count(F.lit(1)).alias("names"))
    return best.filter((F.col("b.d") <= -2) | (F.col("names") == 1)).select("code", F.col("b.name").alias("name"))


def subject(text: Column, record_type: Column, topic_number: Column, phrases: Column, fields: Column, head: Column) -> Column:
    """struct(subject, source): request, mail subject, screen fields, heading, key phrases, start of the text."""
    t = F.coalesce(text, F.lit(""))
    asked = F.trim(F.regexp_extract(t, r"Solicita[çc][ãa]o\s*:\s*(.+)", 1))
    mail = T.email_subject(t)
    screen = F.slice(fields, 1, 5)
    many = (F.size(fields) >= 3) & (F.size(F.regexp_extract_all(t, F.lit(r"(?U)\bcampo\b"), F.lit(0))) >= 3)
    rest = F.trim(F.regexp_replace(t, P.IMAGE, " "))
    start = F.when(head != "", head).when(F.substring(rest, 1, 80) != "", F.substring(rest, 1, 80)).otherwise("(somente imagens)")
    pair = lambda s, w: F.struct(s.alias("subject"), F.lit(w).alias("source"))
    return (
        F.when((record_type == "pedido") & (F.length(asked) > 10), pair(T.shorten(asked), "solicitacao"))
        .when((record_type == "email") & (mail != ""), pair(T.shorten(mail), "assunto do email"))
        .when(many, pair(T.shorten(F.concat(F.lit("campos: "), F.array_join(screen, ", "))), "campos da tela"))
        .when((head != "") & (F.coalesce(topic_number, F.lit("")) == ""), pair(T.shorten(head), "cabecalho"))
        .when(F.size(phrases) > 0, pair(F.btrim(F.array_join(F.slice(phrases, 1, 3), ", "), F.lit(" -")), "palavras-chave"))
        .otherwise(pair(T.shorten(start), "inicio do texto"))
    )


def program_parts(chunks: DataFrame, names: DataFrame) -> DataFrame:
    """(chunk_id, program_part): up to two programs with their names; the first mentioned if there is no main one."""
    split = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\s+"), lambda x: x != "")
    shown = F.when(F.size(split("main_programs")) > 0, F.slice(split("main_programs"), 1, 2)).otherwise(F.slice(split("mentioned_programs"), 1, 1))
    p = chunks.select("chunk_id", F.posexplode(shown).alias("pos", "code")).join(names, "code", "left")
    label = F.when(F.col("name").isNotNull(), F.concat("name", F.lit(" ("), "code", F.lit(")"))).otherwise(F.col("code"))
    g = p.groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("pos", label.alias("l")))).alias("p"))
    return g.select("chunk_id", F.array_join(F.transform("p", lambda x: x["l"]), " + ").alias("program_part"))


def titles(chunks: DataFrame, menu_names: DataFrame | None = None) -> DataFrame:
    """(chunk_id, title, title_source, key_phrases); names of a menu (code, name) come before learnt ones."""
    names = learnt_names(chunks)
    if menu_names is not None:
        both = names.join(menu_names.select("code", F.col("name").alias("menu")), "code", "full")
        names = both.select("code", F.coalesce("menu", "name").alias("name"))
    c = chunks.join(key_phrases(chunks), "chunk_id", "left").join(program_parts(chunks, names), "chunk_id", "left")
    phrases = F.coalesce("key_phrases", F.array().cast("array<string>"))
    # fields and heading are found once a row; the optimizer doesn't copy such costly expressions into each place that reads them
    s = c.withColumns({"key_phrases": phrases, "_fields": T.fields(F.col("text")), "_head": T.heading(F.col("text"))})
    s = s.withColumn("s", subject(F.col("text"), F.col("record_type"), F.col("topic_number"), F.col("key_phrases"), F.col("_fields"), F.col("_head")))
    title = F.when(F.coalesce("program_part", F.lit("")) != "", F.concat("program_part", F.lit(" — "), "s.subject")).otherwise(F.col("s.subject"))
    return s.select("chunk_id", title.alias("title"), F.col("s.source").alias("title_source"), "key_phrases")


def names_from_titles(chunks: DataFrame) -> DataFrame:
    """(code, name) read back from titles "Name (CODE) + ... — subject"; the first one seen wins."""
    parts = F.split(F.substring_index(F.coalesce("title", F.lit("")), " — ", 1), r" \+ ")
    p = chunks.select("seq", F.posexplode(parts).alias("pos", "part")).withColumn("part", F.trim("part"))
    hit = p.filter(F.col("part").rlike(r"^(.*) \(([A-Z]{3,5}\d{1,4})\)$"))
    code, name = F.regexp_extract("part", r"^(.*) \(([A-Z]{3,5}\d{1,4})\)$", 2), F.regexp_extract("part", r"^(.*) \(([A-Z]{3,5}\d{1,4})\)$", 1)
    return hit.groupBy(code.alias("code")).agg(F.min(F.struct("seq", "pos", name.alias("name"))).alias("m")).select("code", F.col("m.name").alias("name"))


def cluster_keywords(texts: DataFrame, k: int = 6, min_df: int = 3, max_share: float = 0.3) -> DataFrame:
    """(cluster, keywords) by class TF-IDF; ``texts`` is (id, cluster, text), cluster null for noise.

    Words of three letters or more and pairs of them; a keyword inside another, or around one, is
    skipped. Equal scores go by keyword.
    """
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), P.IMAGE, " "), r"\b[A-Z]{3,5}\d{1,4}\b", " ")
    stop = sorted(set(P.CLUSTER_STOP.split()))
    words = F.filter(F.regexp_extract_all(F.lower(plain), F.lit(r"(?<![\p{L}\p{N}_])\p{L}{3,}(?![\p{L}\p{N}_])"), F.lit(0)), lambda w: ~w.isin(*stop))
    pairs = F.transform(F.array(words), lambda w: F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))))[0]
    grams = F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))
    long = texts.select("id", "cluster", F.explode(grams).alias("gram")).groupBy("id", "cluster", "gram").agg(F.count(F.lit(1)).alias("n"))
    n = texts.agg(F.count(F.lit(1)).alias("docs"))
    df = long.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).filter((F.col("df") >= min_df) & (F.col("df") <= F.col("docs") * max_share)).select("gram")
    ctf = long.filter("cluster is not null").join(df, "gram").groupBy("cluster", "gram").agg(F.sum("n").alias("c"))
    size = ctf.groupBy("cluster").agg(F.sum("c").alias("size"))
    mean = size.agg(F.avg("size").alias("mean"))
    col = ctf.groupBy("gram").agg(F.sum("c").alias("col"))
    s = ctf.join(size, "cluster").join(col, "gram").crossJoin(F.broadcast(mean))
    s = s.withColumn("score", F.col("c") / F.greatest("size", F.lit(1)) * F.log(1 + F.col("mean") / F.greatest("col", F.lit(1))))
    near = lambda acc, w: F.exists(acc, lambda q: q.contains(w) | w.contains(q))
    pick = F.aggregate(F.transform("g", lambda x: x["gram"]), F.array().cast("array<string>"), lambda acc, w: F.when((F.size(acc) < k) & ~near(acc, w), F.concat(acc, F.array(w))).otherwise(acc))
    # the skip rule runs over the best grams in order; where too many are skipped more of them are taken
    s, most = staged(s.select("cluster", "gram", "score"), "keywords"), 20 * k
    while True:
        top = s.withColumn("r", F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("score"), "gram"))).filter(F.col("r") <= most)
        g = staged(top.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("r", "gram"))).alias("g")).select("cluster", pick.alias("keywords"), F.size("g").alias("seen")), "keywords")
        if not g.filter((F.size("keywords") < k) & (F.col("seen") == most)).limit(1).count():
            return g.select("cluster", "keywords")
        most *= 10
