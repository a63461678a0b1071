"""The menu catalogue over entries made of parts, and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lavra.operators import menu
from lavra.session import table


def _entries(spark, d):
    """Entries of a menu: parts as programs, some of them customised, some with numbered labels or none."""
    p = table(spark, d, "part")
    code = F.concat(F.element_at(F.array(*map(F.lit, ("fatu", "ESTO", "PEDI", "x"))), (F.col("p_partkey") % 4 + 1).cast("int")), (F.col("p_partkey") % 97).cast("string"))
    code = F.when(F.col("p_partkey") % 5 == 0, F.concat(code, F.lit("_c"), (F.col("p_partkey") % 3).cast("string"))).otherwise(code)
    label = F.concat(F.lit("Consulta de "), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.col("p_type"), F.lit(" "))).otherwise(F.lit("")), F.col("p_brand"))
    label = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("  3 - "), label)).when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(label)
    kind = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("T"), (F.col("p_size") % 3).cast("string")))
    return p.select(code.alias("code"), label.alias("label"), kind.alias("type"), F.col("p_partkey").alias("seq"))


def menu_bases(spark, d):
    return menu.base_codes(_entries(spark, d)).select("seq", "code", "base", "label")


def menu_names(spark, d):
    return menu.common_names(_entries(spark, d))


def menu_catalogue(spark, d):
    c = menu.menu_catalogue(_entries(spark, d))
    return c.select("code", "name", "type", F.array_join("variants", "|").alias("variants"), F.array_join("customised", " ").alias("customised"), "entries")


_BASES = """WITH RECURSIVE e AS (SELECT p_partkey AS seq, ['fatu', 'ESTO', 'PEDI', 'x'][p_partkey % 4 + 1] || (p_partkey % 97) || CASE WHEN p_partkey % 5 = 0 THEN '_c' || (p_partkey % 3) ELSE '' END AS code,
  'Consulta de ' || CASE WHEN p_partkey % 3 <> 0 THEN p_type || ' ' ELSE '' END || p_brand AS plain, CASE WHEN p_size % 3 <> 0 THEN 'T' || (p_size % 3) END AS type FROM part),
b AS (SELECT seq, upper(code) AS code, split_part(upper(code), '_', 1) AS base, CASE WHEN seq % 7 = 0 OR seq % 11 <> 0 THEN plain END AS label, type FROM e WHERE regexp_full_match(split_part(upper(code), '_', 1), '[A-Z]{2,6}\\d{1,4}'))"""
_NAMES = (
    _BASES
    + """,
l AS (SELECT base, seq, label, regexp_split_to_array(label, '\\s+') AS w FROM b WHERE label IS NOT NULL),
need AS (SELECT base, greatest(2, floor(count(*) * 0.4)) AS need FROM l GROUP BY 1),
step AS (SELECT base, 0 AS i, []::VARCHAR[] AS low, '' AS prefix FROM need
  UNION ALL SELECT s.base, s.i + 1, list_append(s.low, z.word), z.shown FROM step s, LATERAL (SELECT lower(w[s.i + 1]) AS word, array_to_string(arg_min(w, seq)[1:s.i + 1], ' ') AS shown, count(*) AS n, min(seq) AS q
    FROM l WHERE l.base = s.base AND len(w) > s.i AND list_transform(w[1:s.i], lambda x: lower(x)) = s.low GROUP BY 1 ORDER BY n DESC, q LIMIT 1) z WHERE z.n >= (SELECT need FROM need WHERE need.base = s.base)),
pre AS (SELECT base, trim(arg_max(prefix, i), ' -–(,') AS name FROM step GROUP BY 1),
fr AS (SELECT base, first(label ORDER BY n DESC, q) AS frequent FROM (SELECT base, label, count(*) AS n, min(seq) AS q FROM l GROUP BY 1, 2) GROUP BY 1),
nm AS (SELECT base, CASE WHEN length(name) < 4 THEN frequent ELSE name END AS name FROM pre JOIN fr USING (base))"""
)
QUERIES = {"menu_bases": menu_bases, "menu_names": menu_names, "menu_catalogue": menu_catalogue}
ORACLES = {
    "menu_bases": _BASES + " SELECT seq, code, base, label FROM b",
    "menu_names": _NAMES + " SELECT base, name FROM nm",
    "menu_catalogue": _NAMES
    + """, ty AS (SELECT base, first(type ORDER BY n DESC, q) AS type FROM (SELECT base, type, count(*) AS n, min(seq) AS q FROM b WHERE type IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
v0 AS (SELECT base, label, count(*) AS n, min(seq) AS q FROM l JOIN nm USING (base) WHERE lower(label) <> lower(name) GROUP BY 1, 2),
v1 AS (SELECT *, row_number() OVER (PARTITION BY base, lower(label) ORDER BY n DESC, q) AS r FROM v0), v AS (SELECT base, string_agg(label, '|' ORDER BY n DESC, q, label) AS variants FROM v1 WHERE r = 1 GROUP BY 1),
c AS (SELECT base, count(*)::INT AS entries, coalesce(string_agg(DISTINCT CASE WHEN code <> base THEN code END, ' ' ORDER BY CASE WHEN code <> base THEN code END), '') AS customised FROM b GROUP BY 1)
SELECT base AS code, name, type, coalesce(variants, '') AS variants, customised, entries FROM nm LEFT JOIN ty USING (base) LEFT JOIN v USING (base) JOIN c USING (base)""",
}
