"""Text functions as Column expressions. Null texts give null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.functions import patterns as P

_BLANK = r"[\s ]"


def squeeze(text: Column) -> Column:
    """Carriage returns dropped, runs of blanks and of blank lines collapsed."""
    t = F.regexp_replace(F.replace(text, F.lit("\r"), F.lit("")), r"[ \t]+", " ")
    return F.regexp_replace(t, r"\n[ \t]*\n" + _BLANK + "*", "\n\n")


def codes(text: Column) -> Column:
    """Distinct program codes of known modules, sorted; null gives an empty array."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\b[A-Z]{3,5}[0-9]{1,4}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.filter(found, lambda c: F.regexp_extract(c, "^[A-Z]+", 0).isin(*P.MODULES))))


def text_hash(text: Column) -> Column:
    """First 16 hexadecimal digits of the SHA-1."""
    return F.substring(F.sha1(text), 1, 16)


def body(text: Column, embed_text: Column | None = None) -> Column:
    """Text without captions, after the header line if one is given."""
    t = F.regexp_replace(text, P.IMAGE, " ")
    return t if embed_text is None else F.concat(F.split(embed_text, "\n", 2)[0], F.lit("\n"), t)


def shorten(text: Column, limit: int = 90) -> Column:
    """Blanks squeezed, edge marks trimmed, cut at a word with an ellipsis."""
    s = F.btrim(F.regexp_replace(text, _BLANK + "+", " "), F.lit(" .:-–"))
    cut = F.substring(s, 1, limit)
    at_word = F.when(cut.contains(" "), F.regexp_replace(cut, r"(?s) [^ ]*\z", "")).otherwise(cut)
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(at_word, F.lit("…")))


def clean_label(label: Column) -> Column:
    """A menu label without numbers, stars and dashes before it; null gives an empty text."""
    s = F.btrim(F.regexp_replace(F.coalesce(label, F.lit("")), _BLANK + "+", " "), F.lit(" -–\t"))
    return F.btrim(F.regexp_replace(s, r"^(?:[ \-–]*(?:\d{1,2}\s*[-.)]\s*|\*{2,}[^*]*\*{2,}\s*|[-–]\s*))+", ""), F.lit(" -–"))


def clean_name(name: Column) -> Column:
    """A program name without the words that open a program."""
    n = F.regexp_replace(F.trim(name), r"^(?:Abrir o |Abra o |No |O )?(?:programa|Programa|PROGRAMA)\s+", "")
    return F.btrim(n, F.lit(" -–"))


def normalize_item(item: Column) -> Column:
    """Terms in lower case, other items in upper case."""
    i = F.trim(item)
    return F.when(i.startswith("#"), F.concat(F.lit("#"), F.lower(F.trim(F.substring(i, 2, 10_000))))).otherwise(F.upper(i))


def module_of_programs(programs: Column) -> Column:
    """The module that all programs of a blank-separated list share, else an empty text."""
    mods = F.array_distinct(F.transform(F.filter(F.split(F.coalesce(programs, F.lit("")), r"\s+"), lambda p: p != ""), lambda p: F.regexp_extract(p, "^[A-Z]+", 0)))
    return F.when(F.size(mods) == 1, mods[0]).otherwise("")


def record_type(record: Column) -> Column:
    """pedido, email, teste or documentacao, by how a record starts."""
    asked = record.rlike(r"(?iu)Pedido\s+(?:de\s+)?Servi[çc]o:?\s*\d+")
    mail = record.startswith("De:") | record.startswith("E-mail —")
    return F.when(asked, "pedido").when(mail, "email").when(F.lower(record).startswith("testes"), "teste").otherwise("documentacao")


def substance(text: Column) -> Column:
    """Letters and digits left without markers and the mail mark."""
    t = F.trim(F.regexp_replace(text, P.MARKER, ""))
    return F.regexp_replace(F.regexp_replace(t, r"^E-mail —(?: Assunto:)?", ""), r"[^\p{L}\p{N}_]", "")


def topic_title(text: Column) -> Column:
    """First line up to a sub-item, without its number, at most 140 characters."""
    first = F.split(text, r"\s\d{1,2}\.\d{1,2}[.)]\s|\n", 2)[0]
    return F.trim(F.substring(F.regexp_replace(first, r"^\d{1,2}\s?[.)=]\s*", ""), 1, 140))


def messages(text: Column) -> Column:
    """Distinct message codes without blanks, sorted; null gives an empty array."""
    m = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\b(?:KND|ORA)-\s?\d+"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(m, lambda x: F.regexp_replace(x, r"\s", ""))))


def code_tables(text: Column) -> Column:
    """Distinct tables named in code markers, sorted; null gives an empty array."""
    m = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(P.CODE_MARKER), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform(m, lambda x: F.split(x, r"\s+"))), lambda x: x != "")))


def email_subject(text: Column) -> Column:
    """The first subject line without reply prefixes; empty if there is none."""
    s = F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?m)^(?:E-mail — )?Assunto:[ \t]*([^\n]+)$", 1))
    return F.regexp_replace(s, r"(?i)^(?:(?:RE|RES|ENC|FW|FWD|TR)\s*:\s*)+", "")


def heading(text: Column) -> Column:
    """The first useful line if it can serve as a heading, else an empty text."""
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), P.MARKER, ""), "\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    skip = r"(?iu)^(?:\(\.\.\.\)|Pedido\s+(?:de\s+)?Servi|De:|E-mail —|Enviad|Para:|Cc:)"
    first = F.get(F.filter(lines, lambda x: (x != "") & ~x.rlike(skip)), F.lit(0))
    words = F.size(F.regexp_extract_all(first, F.lit(r"[A-Za-zÀ-ú]+(?:-[A-Za-zÀ-ú]+)*"), F.lit(0)))
    fits = F.length(first).between(8, 80) & ~first.rlike(r"[.,;]\z") & (words >= 2)
    return F.when(fits, first).otherwise("")


def fields(text: Column) -> Column:
    """Screen fields named after field, tab, button..., in order, each once whatever its case; null gives an empty array."""
    up = "A-ZÁÉÍÓÚÂÊÔÃÕÇ"
    pattern = rf"(?U)\b(?:campo|aba|botão|check ?box|opção)\s+[\"“]?([{up}][\p{{L}}\p{{N}}_/()\-]*(?:\s+(?:de|da|do|dos|das|e)?\s*[{up}(][\p{{L}}\p{{N}}_/()\-]*){{0,4}})"
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1)), lambda x: F.btrim(x, F.lit(' -"”')))
    dull = [w for w in P.PHRASE_BOILERPLATE.split()]
    useful = F.filter(found, lambda x: ~F.lower(x).isin(*dull))
    add = lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(useful, F.array().cast("array<string>"), add)


def looks_like_code(line: Column) -> Column:
    """Does a line look like SQL or PL/SQL?"""
    s = F.trim(line)
    letters = F.length(F.regexp_replace(s, r"\P{L}", "")) / F.length(s)
    bare = (F.length(s) > 8) & (letters < 0.55) & ~s.rlike("[a-zà-ú]{4,} [a-zà-ú]{4,} [a-zà-ú]{4,}")
    return (s != "") & (
        s.rlike("(?iuU)" + P.SQL_GO_ON) | s.rlike("(?iuU)" + P.SQL_START) | (s.endswith(";") & s.rlike("[=():]")) | s.contains(":=") | s.rlike("(?i)" + P.SQL_ATTRIBUTE) | bare
    )


def looks_like_prose(line: Column) -> Column:
    """Five or more lower-case words, no semicolon at the end, no SQL word at the start."""
    words = F.size(F.regexp_extract_all(line, F.lit("[a-zà-ú]{3,}"), F.lit(0)))
    return (words >= 5) & ~F.rtrim(line).endswith(";") & ~line.rlike("(?iuU)" + P.SQL_GO_ON)


def drop_caption_tails(text: Column) -> Column:
    """Paragraph starts that end a cut caption, and loose description lines, removed."""
    cut = lambda p: F.when((F.instr(p, "]") > 0) & (F.instr(p, "]") <= 1500) & ((F.instr(p, "[") == 0) | (F.instr(p, "[") > F.instr(p, "]"))), F.substr(p, F.instr(p, "]") + 1)).otherwise(p)
    loose = lambda p: F.btrim(F.regexp_replace(p, r"(?m)^[.\s]*(?:\d\.\s*)?(?:A imagem|Nenhum código)\b.*$", ""), F.lit(" \t\n\r"))
    return F.array_join(F.filter(F.transform(F.split(text, "\n\n"), lambda p: loose(cut(p))), lambda p: p != ""), "\n\n")
