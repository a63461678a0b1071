"""E-mails reduced to the lines their sender newly wrote.

An e-mail is cut into its own segments and its ancestors: earlier messages quoted or forwarded
inside it, in any style, and the earlier e-mails of its thread. Paragraphs of the own segments are
compressed with a dictionary made of the ancestors' text and of closings learnt from all e-mails. A
paragraph that the dictionary shortens abnormally is flagged; its lines are removed only where they
are verified as exact overlaps with the dictionary. Signature blocks are read from the segment's end.

Defined results
* Null and empty texts have no lines. A trailing carriage return is not part of a line.
* Lines are numbered from 1 over LF; lines of white space count but are never new.
* Rows that repeat an id give their lines once. An e-mail without any marker is all new but for its
  closing and what it repeats of its thread, two lines in a row at least. Extra columns are not
  read. Cost grows with the text's length only; a thread is held by one task.
* No ancestor is too far back: lines that repeat one beyond the 24,000 bytes that a dictionary holds
  are put into it first. Paragraphs above 8,000 bytes are judged piece by piece.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.session import staged

# Mail header fields, introductions of quotes, closing formulas, notices and roles in
# Portuguese, Spanish and English.
FIELDS = (
    "de|from|enviada em|enviado em|enviado el|enviado|enviada|sent|date|data|fecha|para|to|cc|cco|bcc|importância|importance|"
    "importancia|assunto|subject|asunto|responder a|reply-to|anexos?|attachments?"
)
HEADER = re.compile(rf"\s*\*?(?:{FIELDS})\s*:\*?(?:\s|$)", re.I)
FROM = re.compile(r"\s*\*?(?:de|from)\s*:\*?\s", re.I)
SUBJECT_MARK = re.compile(r"\s*E-mail —")
FORWARD = re.compile(
    r"\s*-{2,}\s*(?:mensagem (?:original|encaminhada)|mensaje (?:original|reenviado)|original message|forwarded message|"
    r"forwarded by .*|início da mensagem encaminhada|begin forwarded message)\s*:?\s*-*\s*$",
    re.I,
)
RULE = re.compile(r"\s*(?:_{5,}|-{5,}|={5,}|\*{5,})\s*$")
QUOTED = re.compile(r"\s*[>|]")
INTRO_END = re.compile(r"(?:escreveu|escribió|escribio|wrote|a écrit|ha scritto)\s*:\s*$", re.I)
INTRO_START = re.compile(r"\s*(?:em|el|on|no dia|am|le)\s.*\d", re.I)
AFTERTHOUGHT = re.compile(r"\s*(?:p\.?\s?[sd]\.?|obs\.?|n\.?b\.?)\s*:", re.I)
FORMULA = re.compile(
    r"\s*(?:att?|atte|atenciosamente|abra[çc]os?|abs|saludos(?: cordiales)?|un saludo|cordialmente|cordiais saudações|saudações|"
    r"obrigad[oa]|muito obrigad[oa]|grat[oa]|gracias|muchas gracias|atentamente|thanks|thank you|many thanks|best regards|kind regards|"
    r"regards|best|cheers|sincerely|yours sincerely)\s*[,.!;]*\s*$",
    re.I,
)
DELIMITER = re.compile(r"\s*(?:--\s?|_{3,}|-{3,}|\*{3,})\s*$")
DEVICE = re.compile(
    r"\s*(?:enviado (?:do|de|pelo|desde)(?: meu| mi| el| o)? (?:celular|iphone|ipad|android|tel[ée]fono|smartphone|outlook|samsung|m[óo]vil)|"
    r"sent from (?:my|outlook|mail|samsung)|obter o outlook|get outlook|obtener outlook)",
    re.I,
)
CONTACT = re.compile(
    r"\s*(?:(?:tel|fone|telefone|tel[ée]fono|cel|celular|phone|mobile|m[óo]vil|whats(?:app)?|ramal|fax|e-?mail|site|skype)\b\.?\s*:?\s*(?:[+(\d]|\S+@|www|http).*"
    r"|\S+@\S+\.\S+|(?:www\.|https?://)\S+|\+?[\d ().-]{8,})\s*$",
    re.I,
)
NOTICE = re.compile(
    r"\s*(?:aviso legal|aviso de confidencialidad|legal notice|disclaimer|confidential)"
    r"|.*(?:mensagem pode conter informaç|conteúdo desta mensagem é sigiloso|antes de imprimir, pense|pense no (?:seu compromisso com o )?meio ambiente|"
    r"apague este e-mail|destina-se apenas ao seu destinatário|piense en el medio ambiente|mensaje es confidencial|recibió este correo por error|"
    r"consider the environment|attachments are confidential|received this (?:message|e-?mail) in error|intended (?:only|solely) for|dirigido (?:sólo|solo|únicamente|exclusivamente) a)",
    re.I,
)
ROLES = re.compile(
    r"\s*(?:analista|anal[íi]sta|analyst|coordena|coordinad|coordinator|gerente|gerencia|manager|diretor|director|supervisor|supervisión|key user|usuário-chave|pcp|compras|"
    r"purchasing|controladoria|contralor|controlling|depto\.?|departamento|department|dept\.?|logística|logistics|expedição|financeiro|fiscal|contabilidade|suporte|soporte|"
    r"support|vendas|ventas|sales|ti\b|it\b|rh\b|engenharia|engineering|produção|qualidade|assistente|auxiliar|assistant|consultor|consultant)",
    re.I,
)
GREETING = re.compile(
    r"\s*(?:bom dia|boa tarde|boa noite|olá|ola|oi|prezad[oa]s?|car[oa]s?|buen[oa]s? (?:d[íi]as?|tardes|noches)|hola|estimad[oa]s?|hi|hello|dear|good (?:morning|afternoon|evening)|hey)\b",
    re.I,
)
NAME = re.compile(r"\s*[A-ZÀ-Þ][\w'’.-]*(?:\s+(?:d[aeo]s?|del|y|e|[A-ZÀ-Þ][\w'’.-]*)){1,4}\s*$")
SENTENCE = re.compile(r"[.!?:;,]\s*$")

#: A paragraph whose compressed size the dictionary cuts by this share is flagged; closings in fewer e-mails aren't learnt.
ABNORMAL_GAIN, MIN_EMAILS = 0.55, 5
#: Bytes of the ancestors that a dictionary always holds, and of a paragraph that is judged at once.
DICTIONARY, PIECE = 24_000, 8_000


def is_email(record_type: Column) -> Column:
    t = F.lower(F.regexp_replace(record_type, r"^[\s ]+|[\s ]+$", ""))
    return F.regexp_replace(t, "-", "") == "email"


def strip_quote(line: str) -> str:
    return re.sub(r"^[\s>|]+", "", line).strip()


def template(line: str) -> str:
    """A closing line with its addresses and digits masked."""
    s = strip_quote(line)
    s = re.sub(r"\S+@\S+|(?:www\.|https?://)\S+", "@", s)
    return re.sub(r"\d", "0", s)


@dataclass
class Parsed:
    lines: list[str]
    own: list[list[int]] = field(default_factory=list)  # runs of line indexes between quotes
    ancestors: list[int] = field(default_factory=list)
    headers: list[int] = field(default_factory=list)
    sender: str = ""


def parse(text: str) -> Parsed:
    """Cut an e-mail into own segments, ancestors and header lines."""
    lines = [x[:-1] if x.endswith("\r") else x for x in text.split("\n")]
    p, n, i = Parsed(lines), len(lines), 0
    while i < n and not lines[i].strip():
        i += 1
    first = i
    while i < n and (HEADER.match(lines[i]) or (i == first and SUBJECT_MARK.match(lines[i]))):
        if i > first and not lines[i].strip():
            break
        p.headers.append(i)
        if FROM.match(lines[i]):
            p.sender = re.sub(r"<.*|\*", "", lines[i].split(":", 1)[1]).strip()
        i += 1
    # a single line that looks like a header field may be a sentence ("Para resumir: ...")
    if len(p.headers) == 1 and not SUBJECT_MARK.match(lines[p.headers[0]]) and not FROM.match(lines[p.headers[0]]) and not re.match(r"\s*\*?(?:assunto|asunto|subject)\s*:", lines[p.headers[0]], re.I):
        i = p.headers.pop()
    run: list[int] = []

    def close() -> None:
        if run:
            p.own.append(run[:])
            run.clear()

    while i < n:
        x = lines[i]
        header_block = FROM.match(x) and sum(1 for y in lines[i : i + 6] if HEADER.match(y)) >= 3
        if FORWARD.match(x) or header_block or (RULE.match(x) and any(FROM.match(y) for y in _next(lines, i, 1)) and _block(lines, i)):
            close()
            p.ancestors += range(i, n)
            # an afterthought at the very end, after the forwarded text, is the sender's
            last = max((j for j in range(i, n) if lines[j].strip()), default=i)
            if AFTERTHOUGHT.match(lines[last]) and last > i and not lines[last - 1].strip():
                p.ancestors = [j for j in p.ancestors if j != last]
                p.own.append([last])
            return p
        if QUOTED.match(x):
            close()
            p.ancestors.append(i)
        elif _intro(lines, i):
            close()
            p.ancestors.append(i)
            if not INTRO_END.search(x):
                i += 1
                p.ancestors.append(i)
        else:
            run.append(i)
        i += 1
    close()
    return p


def _next(lines: list[str], i: int, k: int) -> list[str]:
    return [y for y in lines[i + 1 : i + 4] if y.strip()][:k]


def _block(lines: list[str], i: int) -> bool:
    """Does a header block of three or more fields follow line i?"""
    return sum(1 for y in lines[i + 1 : i + 8] if HEADER.match(y)) >= 3


def _intro(lines: list[str], i: int) -> bool:
    """An introduction of a quote, on one line or two, with the quote right after it."""
    x = lines[i]
    for k in (0, 1):
        if i + k < len(lines) and INTRO_END.search(lines[i + k]) and (INTRO_START.match(x) or (k == 0 and NAME.match(re.sub(INTRO_END, "", x)))):
            return any(QUOTED.match(y) for y in _next(lines, i + k, 1))
    return False


def closing_lines(p: Parsed, run: list[int], known: frozenset[str] = frozenset()) -> set[int]:
    """Indexes of the closing of one own segment: read upwards, and below any closing formula."""
    out: set[int] = set()
    lines = p.lines
    body = list(run)
    # afterthoughts stand below the closing; they and what follows in their paragraph are kept
    keep: set[int] = set()
    for j in body:
        if AFTERTHOUGHT.match(lines[j]):
            k = j
            while k in run and lines[k].strip():
                keep.add(k)
                k += 1
    body = [j for j in body if j not in keep]

    def fits(j: int) -> bool:
        s = lines[j].strip()
        return bool(FORMULA.match(s) or DELIMITER.match(lines[j]) or DEVICE.match(s) or CONTACT.match(s) or NOTICE.match(s) or template(s) in known)

    def names(j: int) -> bool:
        s = lines[j].strip()
        if p.sender and s == p.sender:
            return True
        return bool(NAME.match(s)) and not GREETING.match(s) and not SENTENCE.search(s) and len(s) <= 60

    while body:
        j = body.pop()
        s = lines[j].strip()
        if not s:
            continue
        if fits(j) or names(j) or (ROLES.match(s) and len(s) <= 45 and not SENTENCE.search(s)):
            out.add(j)
        else:
            break
    # a signature in the middle: a formula or delimiter followed by a name
    for a, j in enumerate(run):
        if j in out or not (FORMULA.match(lines[j]) or DELIMITER.match(lines[j])):
            continue
        k = a + 1
        block = [j]
        while k < len(run) and lines[run[k]].strip() and (fits(run[k]) or names(run[k]) or (ROLES.match(lines[run[k]].strip()) and len(lines[run[k]].strip()) <= 45)):
            block.append(run[k])
            k += 1
        if len(block) > 1:
            out.update(block)
    for j in run:
        if j not in keep and (DEVICE.match(lines[j].strip()) or NOTICE.match(lines[j].strip())) and not _inside(lines, run, j):
            out.add(j)
    return out - keep


def _inside(lines: list[str], run: list[int], j: int) -> bool:
    """Is line j in the middle of a paragraph that goes on after it in lower case?"""
    return j + 1 in run and lines[j + 1].strip()[:1].islower()


def _packed(data: bytes, dictionary: bytes) -> int:
    c = zlib.compressobj(9, zlib.DEFLATED, -15, 9, zlib.Z_DEFAULT_STRATEGY, dictionary) if dictionary else zlib.compressobj(9, zlib.DEFLATED, -15, 9)
    return len(c.compress(data)) + len(c.flush())


def compression_gain(paragraph: str, dictionary: bytes) -> float:
    """Share of the compressed size that the dictionary saves."""
    data = paragraph.encode()
    plain = _packed(data, b"")
    return 1 - _packed(data, dictionary[-32000:]) / plain if plain else 0.0


class Thread:
    """Which lines follow each other in a thread's e-mails so far."""

    def __init__(self) -> None:
        self.pairs: set[tuple[str, str]] = set()

    def add(self, text: str) -> None:
        lines = [s for x in text.split("\n") if (s := strip_quote(x))]
        self.pairs.update(zip(lines, lines[1:]))


def new_lines(text: str | None, closings: frozenset[str] = frozenset(), closing_text: bytes = b"", thread: Thread | None = None) -> list[int]:
    """Numbers of the lines that the sender newly wrote; ``thread`` holds the e-mails before."""
    if not text:
        return []
    p = parse(text)
    ancestors = [s for j in p.ancestors if (s := strip_quote(p.lines[j]))]
    quoted = "\n".join(ancestors).encode()
    # zlib looks back 32 kB and finds the end cheapest: closings first, ancestors last
    dictionary = closing_text[-8000:] + quoted[-DICTIONARY:]
    far = (frozenset(ancestors) if len(quoted) > DICTIONARY else frozenset()) | (_pasted(p, thread) if thread else frozenset())
    held = frozenset(ancestors) | far
    fresh: list[int] = []
    gone: set[int] = set()
    for run in p.own:
        closing = closing_lines(p, run, closings)
        gone |= closing
        left = [j for j in run if j not in closing and p.lines[j].strip()]
        paragraph: list[int] = []
        size = 0
        for j in [*left, None]:
            if j is not None and (not paragraph or (j == paragraph[-1] + 1 and size + len(p.lines[j].encode()) <= PIECE)):
                paragraph.append(j)
                size += len(p.lines[j].encode())
                continue
            if paragraph:
                fresh += _verified(p, paragraph, dictionary, held, far, closings)
            paragraph = [] if j is None else [j]
            size = 0 if j is None else len(p.lines[j].encode())
    return [j + 1 for j in (_beside(p, fresh, thread, gone) if thread else fresh)]


def _verified(p: Parsed, paragraph: list[int], dictionary: bytes, held: frozenset[str], far: frozenset[str], closings: frozenset[str]) -> list[int]:
    """The paragraph's lines less those an abnormal gain points to and an exact overlap confirms."""
    near = [s for j in paragraph if len(s := p.lines[j].strip()) >= 25 and s in far]
    dictionary += "\n".join(near).encode()
    if not dictionary:
        return paragraph
    body = "\n".join(p.lines[j] for j in paragraph)
    # a single line longer than a piece is its own proof
    if not (near and len(paragraph) == 1) and compression_gain(body, dictionary) < ABNORMAL_GAIN:
        return paragraph
    copied = lambda s: (len(s) >= 25 and s in held) or template(s) in closings
    return [j for j in paragraph if GREETING.match(p.lines[j]) or not copied(p.lines[j].strip())]


def _pasted(p: Parsed, thread: Thread) -> frozenset[str]:
    """Own lines that follow each other as in the thread; a line that comes again alone may be written again."""
    own = [s for run in p.own for j in run if (s := p.lines[j].strip())]
    return frozenset(s for pair in zip(own, own[1:]) if pair in thread.pairs for s in pair)


def _beside(p: Parsed, fresh: list[int], thread: Thread, closing: set[int]) -> list[int]:
    """Short lines and greetings go as well where they stand beside a removed line as in the thread."""
    order = [j for run in p.own for j in run if p.lines[j].strip() and j not in closing]
    for seq in (order, order[::-1]):
        kept, last = set(fresh), None
        for j in seq:
            if last is not None and j in kept and last not in kept:
                pair = (p.lines[last].strip(), p.lines[j].strip())
                if (pair if seq is order else pair[::-1]) in thread.pairs:
                    kept.discard(j)
            last = j
        fresh = [j for j in fresh if j in kept]
    return fresh


def _closing_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The templates of all own lines, with whether the line stands in a closing."""
    for b in batches:
        ids, lines, closing = [], [], []
        for i, text in zip(b["id"], b["text"]):
            if not text:
                continue
            p = parse(text)
            own: dict[str, bool] = {}
            for run in p.own:
                ends = closing_lines(p, run)
                for j in run:
                    s = p.lines[j].strip()
                    if s:
                        t = template(s)
                        own[t] = own.get(t, False) or (j in ends and len(s) > 2 and not NAME.match(s))
            ids += [i] * len(own)
            lines += own
            closing += own.values()
        yield pd.DataFrame({"id": pd.Series(ids, dtype=object), "line": pd.Series(lines, dtype=object), "closing": pd.Series(closing, dtype=bool)})


def sender_closings(emails: DataFrame) -> DataFrame:
    """(id, closings): for each e-mail, those of its own lines, masked, that MIN_EMAILS e-mails end with."""
    rows = staged(emails.select("id", "text").mapInPandas(_closing_rows, "id string, line string, closing boolean"), "p5-lines")
    learnt = rows.filter("closing").select("id", "line").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("emails")).filter(F.col("emails") >= MIN_EMAILS).select("line")
    # joined by shuffle at every size: a closing may end any number of e-mails, so its lines are first made distinct
    return rows.join(learnt, "line").groupBy("id").agg(F.sort_array(F.collect_set("line")).alias("closings"))


def newly_written(emails: DataFrame) -> DataFrame:
    """(id, line_no) of the newly written lines of e-mails (id, text).

    With (thread, position) as well, the e-mails of a thread are ancestors of those after them.
    """
    if "thread" not in emails.columns:
        emails = emails.select("id", "text", F.lit(None).cast("string").alias("thread"), F.lit(0).alias("position"))
    one = emails.select("id", "text", F.coalesce("thread", F.col("id")).alias("thread"), "position").dropDuplicates(["id"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        before, out = Thread(), []
        for i, text, closings in pdf.sort_values(["position", "id"])[["id", "text", "closings"]].itertuples(index=False):
            learnt = [] if closings is None else list(closings)
            known = frozenset(c for c in learnt if not SENTENCE.search(c) or FORMULA.match(c) or NOTICE.match(c))
            out.append((i, new_lines(text, known, "\n".join(learnt).encode(), before if before.pairs else None)))
            if text:
                before.add(text)
        return pd.DataFrame(out, columns=["id", "nos"])

    per = one.join(sender_closings(one), "id", "left").groupBy("thread").applyInPandas(run, "id string, nos array<long>")
    return per.select("id", F.explode("nos").alias("line_no"))
