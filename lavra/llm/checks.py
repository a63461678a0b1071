"""SQL that finds the stated cases by brute force, to check the operators' rows."""

from __future__ import annotations

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13)"
_CHUNKS = "c AS (SELECT chunk_id, any_value(text) AS text, any_value(key_phrases) AS key_phrases, any_value(topic_id) AS topic_id, any_value(position) AS position FROM chunks_titled WHERE chunk_id IS NOT NULL GROUP BY chunk_id)"
_VALID = """v AS (SELECT chunk_id AS id, min(vectors)::DOUBLE[] AS v FROM chunk_vectors WHERE len(vectors) = 192 AND list_bool_and(list_transform(vectors, lambda x: isfinite(x))) AND list_bool_or(list_transform(vectors, lambda x: x <> 0))
  AND chunk_id IN (SELECT chunk_id FROM chunks_titled) GROUP BY 1),
u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM v)"""

P1 = f"""WITH {_CHUNKS},
t AS (SELECT chunk_id, regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '\\p{{L}}+') AS w FROM c),
o AS (SELECT DISTINCT chunk_id, regexp_extract_all(strip_accents(lower(p)), '\\p{{L}}+') AS p FROM (SELECT chunk_id, unnest(key_phrases) AS p FROM c) WHERE p IS NOT NULL),
own AS (SELECT chunk_id, array_to_string(p, ' ') AS phrase, len(p) AS n FROM o WHERE len(p) > 0),
g AS (SELECT chunk_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase FROM t, (SELECT DISTINCT n FROM own)),
tf AS (SELECT chunk_id, phrase, count(*) AS tf FROM g WHERE phrase IN (SELECT phrase FROM own) GROUP BY 1, 2), df AS (SELECT phrase, count(*) AS df FROM tf GROUP BY 1)
SELECT chunk_id, phrase FROM own JOIN tf USING (chunk_id, phrase) JOIN df USING (phrase) WHERE tf >= 2 AND df BETWEEN 2 AND 12"""
P3 = f"""WITH {_VALID}, n AS (SELECT a.id, list(b.id ORDER BY b.id) AS near FROM u a, u b WHERE list_dot_product(a.v, b.v) >= 0.58 GROUP BY 1),
whole AS (SELECT near FROM n GROUP BY near HAVING count(*) = len(near) AND count(*) >= 15)
SELECT id AS chunk_id, near[1] AS cluster_key FROM n WHERE near IN (SELECT near FROM whole)"""
P4 = f"""WITH RECURSIVE {_CHUNKS}, t AS (SELECT topic_id, string_agg(text, chr(10) || chr(10) ORDER BY position) AS text FROM c WHERE topic_id IS NOT NULL GROUP BY 1),
x AS (SELECT topic_id, length(text) AS n, regexp_replace(text, '[^ \\t\\n\\r.!?:;]', 'x', 'g') AS x FROM t WHERE length(text) > 2400),
m AS (SELECT topic_id, n, translate(x, chr(13), 'x') AS lf, translate(x, {_BLANKS}, '    ') AS bl, translate(translate(x, {_BLANKS}, '    '), '!?:;', '....') AS mk FROM x),
cut AS (SELECT topic_id, 0 AS piece_no, 0 AS start_pos, 0 AS end_pos, 0 AS s FROM m
  UNION ALL SELECT topic_id, piece_no + 1, s, e, CASE WHEN e = n THEN -1 WHEN q > 0 THEN e - 201 + q ELSE e - 200 END FROM (
    SELECT topic_id, piece_no, s, n, e, strpos(substr(bl, e - 200, 200), ' ') AS q FROM (
      SELECT topic_id, piece_no, s, n, bl, CASE WHEN n - s <= 2400 THEN n WHEN r1 > 0 THEN s + 2401 - r1 WHEN r2 > 0 THEN s + 2401 - r2 WHEN r3 > 0 THEN s + 2401 - r3 ELSE s + 2400 END AS e FROM (
        SELECT cut.topic_id, piece_no, s, n, bl, strpos(reverse(substr(lf, s + 400, 2001)), chr(10) || chr(10)) AS r1, strpos(reverse(substr(mk, s + 400, 2001)), ' .') AS r2,
          strpos(reverse(substr(bl, s + 401, 2000)), ' ') AS r3 FROM cut JOIN m USING (topic_id) WHERE s >= 0))))
SELECT topic_id, piece_no::BIGINT AS piece_no, start_pos::BIGINT AS start_pos, end_pos::BIGINT AS end_pos FROM cut WHERE piece_no > 0"""
P6 = f"""WITH {_VALID}, s AS (SELECT a.id AS a, b.id AS b, list_dot_product(a.v, b.v) AS s FROM u a JOIN u b ON a.id <> b.id WHERE list_dot_product(a.v, b.v) >= 0.95),
k AS (SELECT a, b FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY round(s, 12) DESC, b) AS r FROM s) WHERE r <= 5)
SELECT x.a AS chunk_a, x.b AS chunk_b FROM k x JOIN k y ON y.a = x.b AND y.b = x.a WHERE x.a < x.b"""
P8 = """WITH i AS (SELECT item_id, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+') AS w FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM i),
own AS (SELECT g, min(item_id) AS item_id FROM g GROUP BY g HAVING count(DISTINCT item_id) = 1),
h AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM d)
SELECT DISTINCT doc_id, item_id FROM h JOIN own USING (g)"""
