"""Queries of line dedup, conversation repair and the source audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastemill.llm import conversations, divergence, lines
from tastemill.llm.registry import query, table


_BLANKS = r"\x20\x09-\x0D"


def _crc32(x: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    step = "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    one = f"list_reduce(list_prepend(xor(acc, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})"
    codes = f"list_transform(string_split({x}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda acc, x: {one}), 4294967295::BIGINT)"


def _state(name: str, cost: int, edits: str, when: str | None = None, late: bool = True) -> str:
    """The state ``name`` after some edits of row x, or one that nothing is worse than."""
    dear = " + CASE x.f WHEN 't' THEN 3 ELSE 0 END" if late else ""
    found = f"{{'c': q.{name}.c + {cost}{dear}, 'a': q.{name}.a || '{edits}'}}"
    usable = "x.f NOT IN ('b', 'd')" if late else "true"
    return f"CASE WHEN {usable} AND {when or 'true'} THEN {found} ELSE {{'c': 1000000000, 'a': ''}} END"


def _least(*found: str) -> str:
    return f"list_min([{', '.join(found)}])"


#: After a row: nothing yet, after s, after u, after a. Inserted roles lead from each of them to u or to a.
_FOLD = (
    "{'i': '', 'f': '', "
    f"'n': {_state('n', 4, 'D', late=False)}, "
    f"'s': {_least(_state('s', 4, 'D', late=False), _state('n', 0, 'K', 'x.i = chr(115)'))}, "
    "'u': " + _least(
        _state("u", 4, "D", late=False),
        *(_state(p, c, e, w) for p in ("n", "s", "a") for c, e, w in ((0, "K", "x.i = chr(117)"), (3, "R", None))),
        _state("u", 3, "IK", "x.i = chr(117)"), _state("u", 6, "IR"),
    )
    + ", 'a': " + _least(
        _state("a", 4, "D", late=False),
        _state("u", 0, "K", "x.i = chr(97)"), _state("u", 3, "R"),
        *(_state(p, c, e, w) for p in ("n", "s", "a") for c, e, w in ((3, "IK", "x.i = chr(97)"), (6, "IR", None))),
    )
    + "}"
)
_FAR = "{'c': 1000000000, 'a': ''}"

_REPAIR_SQL = f"""
WITH k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM d),
r AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS p,
    CASE WHEN NOT regexp_matches(text, '[^{_BLANKS}]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
      WHEN regexp_matches(text, '[.!?][{_BLANKS}]*$') THEN '' ELSE 't' END AS f FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE f = 'b') AS blank,
    count(*) FILTER (WHERE f = 'd') AS duplicate, count(*) FILTER (WHERE f = 't') AS truncated,
    count(*) FILTER (WHERE p || i NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'i': i, 'f': f, 'n': {_FAR}, 's': {_FAR}, 'u': {_FAR}, 'a': {_FAR}}} ORDER BY pos) AS rows FROM r GROUP BY conv_id),
e AS (
  SELECT *, list_reduce(list_prepend({{'i': '', 'f': '', 'n': {{'c': 0, 'a': ''}}, 's': {_FAR}, 'u': {_FAR}, 'a': {_FAR}}}, rows),
    lambda q, x: {_FOLD}) AS z FROM g),
b AS MATERIALIZED (
  SELECT * EXCLUDE (rows, z), list_min([z.n, {{'c': z.s.c + 6, 'a': z.s.a || 'II'}}, {{'c': z.u.c + 3, 'a': z.u.a || 'I'}}, z.a]) AS best FROM e),
t AS (
  SELECT conv_id, unnest(string_split(best.a, '')) AS edit, generate_subscripts(string_split(best.a, ''), 1) AS step FROM b WHERE best.a <> ''),
w AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY step) AS pos FROM t),
m AS (
  SELECT w.conv_id, edit, role, text, i, row_number() OVER (PARTITION BY w.conv_id ORDER BY step) AS m
  FROM w LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos AND edit <> 'I' WHERE edit <> 'D'),
h AS (SELECT *, max(CASE WHEN m = 1 AND edit = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS lead_s FROM m),
x AS (
  SELECT conv_id, sha256(string_agg(CASE edit WHEN 'K' THEN role ELSE CASE (m - lead_s) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY m)) AS sha FROM h GROUP BY conv_id)
SELECT v.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM v.conv_id
"""


@query("op11_conversation_repair", _REPAIR_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


_LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS MATERIALIZED (
  SELECT doc_id, p, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
"""


@query("op12_line_dedup", _LINES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents")).drop("kept_text")


_AUDIT_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS MATERIALIZED (
  SELECT lang, source, doc_id, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS n
  FROM (SELECT lang, source, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
  GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS all_n FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
v AS (SELECT lang, count(*) AS v, sum(all_n) AS total FROM k GROUP BY ALL),
c AS (SELECT lang, source, term, sum(n) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (
  SELECT lang, source, total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (coalesce(g.total, 0) + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (all_n + 2)) // (v.total + 2 * v) AS q
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 10
"""


@query("op13_source_divergence", _AUDIT_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))
