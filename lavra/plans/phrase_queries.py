"""SQL that checks the text, phrase and title queries."""

from __future__ import annotations

from lavra.functions import patterns as P
from lavra.operators.phrases import NAME_AFTER, NAME_BEFORE

_UP = "A-ZÁÉÍÓÚÂÊÔÃÕÇ"
_WORD = "[A-Za-zÀ-ú]+(-[A-Za-zÀ-ú]+)*"
_MARKER = "\\[(Imagem|Código):[^\\]]*\\]"
_MODULES = "|".join(P.MODULES)
_EDGE = "[^\\p{L}\\p{N}_]"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"


_STOP, _DULL = _list(P.PHRASE_STOP.split()), _list([*P.PHRASE_STOP.split(), *P.PHRASE_BOILERPLATE.split()])

HEADING = f"""CASE WHEN length(first) BETWEEN 8 AND 80 AND NOT regexp_matches(first, '[.,;]$') AND len(regexp_extract_all(first, '{_WORD}')) >= 2 THEN first ELSE '' END"""
FIRST_LINE = f"""list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '{_MARKER}', '', 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))),
  lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(\\(\\.\\.\\.\\)|Pedido\\s+(de\\s+)?Servi|De:|E-mail —|Enviad|Para:|Cc:)'))[1]"""
_NAME = f"([{_UP}][\\p{{L}}\\p{{N}}_/()\\-]*(?:\\s+(?:de|da|do|dos|das|e)?\\s*[{_UP}(][\\p{{L}}\\p{{N}}_/()\\-]*){{0,4}})"
FIELD_LIST = f"""list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '(^|{_EDGE})(?:campo|aba|botão|check ?box|opção)\\s+["“]?{_NAME}', 2), lambda x: trim(x, ' -"”')),
  lambda x: NOT list_contains({_list(P.PHRASE_BOILERPLATE.split())}, lower(x)))"""
FIELDS = "list_filter(f, lambda x, i: list_position(list_transform(f, lambda y: lower(y)), lower(x)) = i)"
_TAILS = f"""list_filter(list_transform(list_transform(string_split(text, chr(10) || chr(10)), lambda p: CASE WHEN strpos(p, ']') BETWEEN 1 AND 1500 AND (strpos(p, '[') = 0 OR strpos(p, '[') > strpos(p, ']')) THEN substr(p, strpos(p, ']') + 1) ELSE p END),
  lambda p: trim(regexp_replace(p, '(?m)^[.\\s]*(\\d\\.\\s*)?(A imagem|Nenhum código)\\b.*$', '', 'g'), ' ' || chr(9) || chr(10) || chr(13))), lambda p: p <> '')"""


def _no_ahead(pattern: str) -> str:
    """A pattern that only has to match, with its last look-ahead as an ordinary end."""
    return pattern.replace("(?=\\W|$)", f"(?:{_EDGE}|$)").replace("'", "''")


CHUNKS = """c AS (SELECT chunk_id, any_value(text) AS text, any_value(doc_id) AS doc_id, any_value(position) AS position, any_value(record) AS record, any_value(record_type) AS record_type,
  any_value(topic_number) AS topic_number, any_value(main_programs) AS main_programs, any_value(mentioned_programs) AS mentioned_programs FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id)"""
CANDIDATES = f"""{CHUNKS},
seg AS (SELECT chunk_id, unnest(regexp_split_to_array(regexp_replace(regexp_replace(coalesce(text, ''), '{_MARKER}', ' ', 'g'), '\\b({_MODULES})\\d{{1,4}}\\b', ' ', 'g'), '[.;:!?\\n()"“”*•]')) AS s FROM c),
wl AS (SELECT chunk_id, list_transform(regexp_extract_all(s, '{_WORD}'), lambda x: lower(x)) AS w FROM seg),
mk AS (SELECT chunk_id, w, list_transform(w, lambda x: CASE WHEN length(x) > 2 AND NOT list_contains({_DULL}, x) THEN 2 WHEN list_contains({_STOP}, x) THEN 1 ELSE 0 END) AS m FROM wl WHERE len(w) > 0),
ph AS (SELECT chunk_id, unnest(list_concat(list_filter(w, lambda x, i: m[i] = 2),
  list_filter(list_transform(range(1, len(w)), lambda i: CASE WHEN m[i] = 2 AND m[i + 1] = 2 THEN w[i] || ' ' || w[i + 1] END), lambda x: x IS NOT NULL),
  list_filter(list_transform(range(1, len(w) - 1), lambda i: CASE WHEN m[i] = 2 AND m[i + 1] >= 1 AND m[i + 2] = 2 THEN w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END), lambda x: x IS NOT NULL))) AS phrase FROM mk),
tf AS (SELECT chunk_id, phrase, count(*) AS tf FROM ph GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM c),
df AS (SELECT phrase, count(*) AS df FROM tf GROUP BY 1),
sc AS (SELECT chunk_id, phrase, tf, df, (1 + ln(tf)) * ln(n.n / df) * (1 + 0.5::DOUBLE * (len(string_split(phrase, ' ')) - 1)) AS score FROM tf JOIN df USING (phrase), n WHERE df >= 2 AND df <= n.n * 0.15::DOUBLE),
kp AS (SELECT chunk_id, list_reduce(list(phrase ORDER BY score DESC, phrase DESC).list_transform(lambda p: [p]), lambda acc, x: CASE WHEN len(acc) < 5 AND NOT list_has_any(string_split(array_to_string(acc, ' '), ' '), string_split(x[1], ' ')) THEN list_concat(acc, x) ELSE acc END, []::VARCHAR[]) AS key_phrases FROM sc GROUP BY 1)"""
_NAMES = f"""nm AS (SELECT doc_id, position, unnest(regexp_extract_all(coalesce(text, ''), '{NAME_BEFORE}', 2)) AS code, unnest(regexp_extract_all(coalesce(text, ''), '{NAME_BEFORE}', 1)) AS name FROM c
  UNION ALL SELECT doc_id, position, unnest(regexp_extract_all(coalesce(text, ''), '{NAME_AFTER}', 1)), unnest(regexp_extract_all(coalesce(text, ''), '{NAME_AFTER}', 2)) FROM c),
n1 AS (SELECT code, trim(regexp_replace(trim(name), '^(Abrir o |Abra o |No |O )?(programa|Programa|PROGRAMA)\\s+', ''), ' -–') AS name, doc_id, position FROM nm),
n2 AS (SELECT code, name, count(*) AS n, min((doc_id, position)) AS q FROM n1 WHERE length(name) BETWEEN 4 AND 45 AND NOT (upper(name) = name AND lower(name) <> name) GROUP BY 1, 2),
learnt AS (SELECT code, name FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, q, name) AS r, count(*) OVER (PARTITION BY code) AS k FROM n2) WHERE r = 1 AND (n >= 2 OR k = 1))"""


def _short(s: str) -> str:
    q = f"trim(regexp_replace({s}, '[\\s\\x{{00A0}}]+', ' ', 'g'), ' .:-–')"
    return f"CASE WHEN length({q}) <= 90 THEN {q} ELSE regexp_replace(substr({q}, 1, 90), ' [^ ]*$', '') || '…' END"


TITLES = f"""WITH {CANDIDATES}, {_NAMES},
pg AS (SELECT chunk_id, list_filter(regexp_split_to_array(coalesce(main_programs, ''), '\\s+'), lambda x: x <> '') AS mp, list_filter(regexp_split_to_array(coalesce(mentioned_programs, ''), '\\s+'), lambda x: x <> '') AS xp FROM c),
pp AS (SELECT chunk_id, unnest(CASE WHEN len(mp) > 0 THEN mp[1:2] ELSE xp[1:1] END) AS code, unnest(range(1, 1 + len(CASE WHEN len(mp) > 0 THEN mp[1:2] ELSE xp[1:1] END))) AS i FROM pg),
part AS (SELECT chunk_id, string_agg(CASE WHEN name IS NOT NULL THEN name || ' (' || code || ')' ELSE code END, ' + ' ORDER BY i) AS part FROM pp LEFT JOIN learnt USING (code) GROUP BY 1),
s0 AS (SELECT c.*, coalesce(text, '') AS t, {FIRST_LINE} AS first, {FIELD_LIST} AS f, coalesce(key_phrases, []) AS kp FROM c LEFT JOIN kp USING (chunk_id)),
s1 AS (SELECT *, coalesce({HEADING}, '') AS head, {FIELDS} AS fl, trim(regexp_extract(t, 'Solicita[çc][ãa]o\\s*:\\s*(.+)', 1)) AS asked, trim(regexp_replace(t, '\\[Imagem:[^\\]]*\\]', ' ', 'g')) AS rest,
  regexp_replace(trim(regexp_extract(t, '(?m)^(E-mail — )?Assunto:[ \\t]*([^\\n]+)$', 2)), '(?i)^((RE|RES|ENC|FW|FWD|TR)\\s*:\\s*)+', '') AS mail FROM s0),
s2 AS (SELECT *, CASE WHEN record_type = 'pedido' AND length(asked) > 10 THEN 'solicitacao' WHEN record_type = 'email' AND mail <> '' THEN 'assunto do email'
  WHEN len(fl) >= 3 AND len(regexp_extract_all(t, '(^|{_EDGE})campo\\b')) >= 3 THEN 'campos da tela' WHEN head <> '' AND coalesce(topic_number, '') = '' THEN 'cabecalho' WHEN len(kp) > 0 THEN 'palavras-chave' ELSE 'inicio do texto' END AS title_source FROM s1),
s3 AS (SELECT *, CASE title_source WHEN 'solicitacao' THEN {_short('asked')} WHEN 'assunto do email' THEN {_short('mail')} WHEN 'campos da tela' THEN {_short("('campos: ' || array_to_string(fl[1:5], ', '))")}
  WHEN 'cabecalho' THEN {_short('head')} WHEN 'palavras-chave' THEN trim(array_to_string(kp[1:3], ', '), ' -')
  ELSE {_short("(CASE WHEN head <> '' THEN head WHEN substr(rest, 1, 80) <> '' THEN substr(rest, 1, 80) ELSE '(somente imagens)' END)")} END AS subject FROM s2)
SELECT chunk_id, CASE WHEN coalesce(part, '') <> '' THEN part || ' — ' || subject ELSE subject END AS title, title_source, array_to_string(kp, '|') AS key_phrases FROM s3 LEFT JOIN part USING (chunk_id)"""
_CLUSTER_STOP = _list(P.CLUSTER_STOP.split())


def _tokens(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '\\p{{L}}{{3,}}') AND NOT list_contains({_CLUSTER_STOP}, x))"


_PLAIN = f"regexp_replace(regexp_replace(coalesce(text, ''), '{P.IMAGE}', ' ', 'g'), '\\b[A-Z]{{3,5}}\\d{{1,4}}\\b', ' ', 'g')"
_GRAMS = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
KEYWORDS = f"""WITH {CHUNKS},
l AS (SELECT chunk_id, CASE WHEN record % 10 <> 9 THEN record % 10 END AS cluster, {_tokens(_PLAIN)} AS w FROM c),
g AS (SELECT chunk_id, cluster, unnest({_GRAMS}) AS gram FROM l), tf AS (SELECT chunk_id, cluster, gram, count(*) AS n FROM g GROUP BY ALL),
df AS (SELECT gram FROM tf GROUP BY 1 HAVING count(*) >= 3 AND count(*) <= 0.3::DOUBLE * (SELECT count(*) FROM c)),
ct AS (SELECT cluster, gram, sum(n)::DOUBLE AS k FROM tf JOIN df USING (gram) WHERE cluster IS NOT NULL GROUP BY 1, 2), z AS (SELECT cluster, sum(k) AS size FROM ct GROUP BY 1), cl AS (SELECT gram, sum(k) AS col FROM ct GROUP BY 1),
s AS (SELECT cluster, gram, k / size * ln(1 + (SELECT avg(size) FROM z) / col) AS score FROM ct JOIN z USING (cluster) JOIN cl USING (gram)),
r AS (SELECT cluster, list(gram ORDER BY score DESC, gram) AS g FROM s GROUP BY 1)
SELECT cluster, array_to_string(list_reduce(list_transform(g, lambda x: [x]), lambda acc, x: CASE WHEN len(acc) < 6 AND len(list_filter(acc, lambda q: contains(q, x[1]) OR contains(x[1], q))) = 0 THEN list_concat(acc, x) ELSE acc END, []::VARCHAR[]), '|') AS keywords FROM r"""
TFIDF = f"""WITH {CHUNKS}, l AS (SELECT chunk_id, {_tokens("coalesce(text, '')")} AS w FROM c), g AS (SELECT chunk_id, unnest({_GRAMS}) AS term FROM l), tf AS (SELECT chunk_id, term, count(*) AS n FROM g GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 3 AND count(*) <= 0.4::DOUBLE * (SELECT count(*) FROM c) ORDER BY sum(n) DESC, term LIMIT 60000),
w AS (SELECT chunk_id, term, (1 + ln(n)) * (ln((1 + (SELECT count(*) FROM c)) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term))
SELECT chunk_id AS id, count(*) AS terms, round(max(w) / sqrt(sum(w * w)), 6) AS largest FROM w GROUP BY 1"""
_CODE = _no_ahead(P.SQL_GO_ON), _no_ahead(P.SQL_START)
LINES = f"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), s AS (SELECT line, trim(line, ' ') AS s FROM l),
k AS (SELECT s <> '' AND (regexp_matches(s, '(?i){_CODE[0]}') OR regexp_matches(s, '(?i){_CODE[1]}') OR (s LIKE '%;' AND regexp_matches(s, '[=():]')) OR contains(s, ':=') OR regexp_matches(s, '(?i){P.SQL_ATTRIBUTE}')
  OR (length(s) > 8 AND length(regexp_replace(s, '\\P{{L}}', '', 'g')) / length(s) < 0.55 AND NOT regexp_matches(s, '{P.WORDS_IN_A_ROW}'))) AS code,
  len(regexp_extract_all(line, '[a-zà-ú]{{3,}}')) >= 5 AND NOT rtrim(line, ' ') LIKE '%;' AND NOT regexp_matches(line, '(?i){_CODE[0]}') AS prose FROM s)
SELECT code, prose, count(*) AS lines FROM k GROUP BY 1, 2"""


def _has(*variants: str) -> str:
    return f"regexp_matches(t, '(^|{_EDGE})({'|'.join(variants)})($|{_EDGE})')"


_TERMS = {"nota fiscal": ("nota\\s+fiscal", "nf-e"), "estoque": ("inventari[\\p{L}\\p{N}_]*",), "pedido": ("pedido\\s+de\\s+venda", "pedido\\s+de\\s+compra"), "frete": ("conhecimento\\s+de\\s+frete",)}
TERMS = (
    f"WITH {CHUNKS}, f AS (SELECT regexp_replace(strip_accents(lower(coalesce(text, ''))), '\\[(imagem|codigo):[^\\]]*\\]', ' ', 'g') AS t FROM c)"
    + " UNION ALL ".join(f" SELECT '#{n}' AS term, count(*) AS chunks FROM f WHERE {_has(*v)} HAVING count(*) > 0" for n, v in _TERMS.items())
)
ORACLES = {
    "text_heading": f"SELECT doc_id, coalesce({HEADING}, '') AS heading FROM (SELECT doc_id, {FIRST_LINE} AS first FROM documents)",
    "text_fields": f"SELECT doc_id, array_to_string({FIELDS}, '|') AS fields FROM (SELECT doc_id, {FIELD_LIST} AS f FROM documents)",
    "text_caption_tails": f"SELECT doc_id, length(array_to_string({_TAILS}, chr(10) || chr(10))) AS n FROM documents",
    "line_classes": LINES,
    "term_items": TERMS,
    "phrase_df": f"WITH {CANDIDATES} SELECT phrase, df FROM df",
    "phrase_scores": f"WITH {CANDIDATES} SELECT chunk_id, phrase, tf, df, round(score, 6) AS score FROM sc",
    "key_phrases": f"WITH {CANDIDATES} SELECT chunk_id, array_to_string(key_phrases, '|') AS key_phrases FROM kp",
    "chunk_titles": TITLES,
    "cluster_keywords": KEYWORDS,
    "tfidf_weights": TFIDF,
}
