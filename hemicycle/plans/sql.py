"""Shared pieces of the DuckDB counterparts."""

from __future__ import annotations

from ..functions import constants as K


def quoted(words) -> str:
    return ", ".join("'" + str(w) + "'" for w in words)


WORDS = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+')"
VALID_WORDS = (
    "list_filter(" + WORDS.format("lower(text)") + f", lambda w: regexp_full_match(w, '{K.VALID_WORD_PATTERN[1:-1]}'))"
)
STOP = quoted(K.STOP_WORDS)
TOP_STOP = quoted(K.TOP_WORD_STOP_WORDS)

#: ``vec(vec_id, cluster, i, x)``: one row per coordinate.
COORDS = """
coords AS (
  SELECT vec_id, label AS cluster, i, embedding[i]::DOUBLE AS x
  FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
)
"""

SESSIONS = """
sessions AS (
  SELECT 'src' || k AS session_id, arg_max(o_orderdate, ROW(o_totalprice, o_orderkey))::DATE AS date,
         CASE WHEN k % 2 = 0 THEN 'house' ELSE 'senate' END AS chamber
  FROM (SELECT *, o_custkey % 20 AS k FROM orders) GROUP BY k
)
"""

FULL = (
    SESSIONS
    + f""",
full_table AS (
  SELECT e.vec_id AS intervention_id, e.label AS cluster, d.source AS session_id, s.date, s.chamber,
         {VALID_WORDS} AS words
  FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id JOIN sessions s ON s.session_id = d.source
)
"""
)

#: Tf-idf keywords of documents, one corpus per source.
KEYWORDS = rf"""
tokens AS (
  SELECT source, doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM documents
),
tf AS (
  SELECT source, doc_id, term, count(*) AS tf FROM tokens WHERE term NOT IN ({STOP}) GROUP BY ALL
),
dfs AS (SELECT source, term, count(*) AS df FROM tf GROUP BY ALL),
sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY ALL),
weighted AS (
  SELECT source, doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w
  FROM tf JOIN dfs USING (source, term) JOIN sizes USING (source)
),
kept AS (
  SELECT source, doc_id, term
  FROM (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY source, doc_id)) AS weight FROM weighted)
  WHERE round(weight, 9) > 0.1
)
"""

LABELLED = (
    KEYWORDS
    + """,
labelled AS (
  SELECT e.label AS cluster, k.doc_id, k.term AS word FROM kept k JOIN embeddings e ON e.vec_id = k.doc_id
)
"""
)

EDGES = """
edges AS (
  SELECT a.cluster, a.word AS w1, b.word AS w2, count(*) AS weight
  FROM labelled a JOIN labelled b ON a.doc_id = b.doc_id AND a.word < b.word GROUP BY ALL
)
"""

DIRECTED = """
directed AS (
  SELECT cluster, w1 AS node, w2 AS nbr, weight FROM edges
  UNION ALL SELECT cluster, w2, w1, weight FROM edges
)
"""

NUMBERED = """
numbered AS (
  SELECT d.cluster, d.node, d.nbr,
         row_number() OVER (PARTITION BY d.cluster, d.node
                            ORDER BY substr(md5(d.nbr), 1, 2), d.nbr) AS slot,
         count(*) OVER (PARTITION BY d.cluster, d.node) AS degree
  FROM directed d
)
"""

_MONTH_LIST = "[" + quoted(K.MONTHS) + "]"

#: Gazettes as built by ``plans.tables.gazettes``.
GAZETTES = f"""
turns AS (
  SELECT conv_id AS doc, turn, role,
         CASE WHEN role = 'user'
              THEN '*b-*' || CASE WHEN (conv_id + turn) % 5 = 0 THEN 'Proyecto de ley ' ELSE '' END || text || '*-b*'
              ELSE text END || ' ' || chr(10) || chr(10) AS s
  FROM conversations
),
gazettes AS (
  SELECT doc,
         array_to_string(['Edición de 32 páginas', 'IMPRENTA NACIONAL DE COLOMBIA - www.imprenta.gov.co',
           'Página 7 del acta', 'Año XXV Nº 120 - Bogotá', 'SENADO DE LA REPÚBLICA',
           '*b-*ACTA NÚMERO ' || doc || ' DE 2016*-b*',
           CASE doc % 3 WHEN 0 THEN 'Cámara de Representantes' WHEN 1 THEN 'Senado, Comisión Primera'
                ELSE 'Senado, sesión plenaria' END,
           'Bogotá, ' || (doc % 31 + 1) || ' de ' || {_MONTH_LIST}[doc % 12 + 1] || ' de ' || (doc % 20 + 2000)
         ], ' ' || chr(10)) || ' ' || chr(10) || chr(10) ||
         (SELECT string_agg(s, '' ORDER BY turn) FROM turns t WHERE t.doc = g.doc) AS raw_text
  FROM (SELECT DISTINCT conv_id AS doc FROM conversations) g
)
"""


def cleaned(source: str, key: str, raw: str) -> str:
    """CTEs ending in ``cleaned(key, clean_text)``; each step is one pattern."""
    nl = "chr(10)"
    ws = r"[\s]"
    return rf"""
c1 AS (SELECT {key}, regexp_replace(regexp_replace(regexp_replace({raw},
         '(?i)IMPRENTA\s*NACIONAL\s*DE\s*COLOMBIA.*|www\.\w+\.gov\.co', '', 'g'),
         '(?i)Página\s*\d+|Edición\s*de.*páginas', '', 'g'),
         '(?i)Año.*Nº.*', '', 'g') AS t FROM {source}),
c2 AS (SELECT {key}, array_to_string(list_filter(string_split(t, {nl}),
         lambda l: regexp_matches(l, '[a-z]')), {nl}) AS t FROM c1),
c3 AS (SELECT {key}, replace(trim(regexp_replace(t, '\n{ws}*\n', {nl}, 'g'), ' ' || {nl}), '- ' || {nl}, '') AS t FROM c2),
c4 AS (SELECT {key}, regexp_replace(t, '\*-b\*{ws}*\n{ws}*\*b-\*', ' ', 'g') AS t FROM c3),
c5 AS (SELECT {key}, replace(replace(t, '*-b*', {nl} || '*-b*' || {nl}), '*b-*', {nl} || '*b-*' || {nl}) AS t FROM c4),
c6 AS (SELECT {key}, trim(regexp_replace(t, '\n{ws}*\n', {nl}, 'g'), ' ' || {nl}) AS t FROM c5),
c7 AS (SELECT {key}, trim(regexp_replace(t, ' {{2,}}', ' ', 'g'), ' ' || {nl}) AS t FROM c6),
c8 AS (SELECT {key}, trim(replace(t, {nl}, ' ')) AS t FROM c7),
cleaned AS (SELECT {key}, lower(trim(substr(
         regexp_replace(t, '(?s)^.*?ACTA NÚMERO \d+ DE \d+', ''), 6))) AS clean_text FROM c8)
"""


#: Headline pairs of cleaned gazettes by plain windows over each document.
PAIRS = (
    GAZETTES
    + ","
    + cleaned("gazettes", "doc", "raw_text")
    + """,
pieces AS (
  SELECT doc, i, p[i] AS piece
  FROM (SELECT doc, p, unnest(range(2, len(p) + 1)) AS i
        FROM (SELECT doc, string_split(clean_text, '*b-*') AS p FROM cleaned))
),
events AS (
  SELECT doc, i * 2 AS pos, trim(split_part(piece, '*-b*', 1)) AS part,
         CASE WHEN part LIKE '%proyecto%' OR length(part) <= 5 THEN NULL ELSE 'H' END AS kind
  FROM pieces
  UNION ALL
  SELECT doc, i * 2 + 1, trim(split_part(piece, '*-b*', 2)) AS part,
         CASE WHEN length(part) >= 5 THEN 'T' ELSE 'S' END FROM pieces
),
flagged AS (
  SELECT *, last_value(CASE WHEN kind <> 'S' THEN kind END IGNORE NULLS) OVER (
              PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
         count_if(kind = 'H') OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heads
  FROM events WHERE kind IS NOT NULL
),
grouped AS (
  SELECT *, sum(CASE WHEN kind = 'H' AND (coalesce(heads, 0) = 0 OR prev <> 'H') THEN 1 ELSE 0 END)
              OVER (PARTITION BY doc ORDER BY pos) AS pair
  FROM flagged
),
pairs AS (
  SELECT doc, pair::INT AS pair,
         string_agg(CASE WHEN kind <> 'T' THEN part END, ' ' ORDER BY pos) AS headline,
         string_agg(CASE WHEN kind = 'T' THEN part END, ' ' ORDER BY pos) AS body
  FROM grouped WHERE pair > 0 GROUP BY ALL HAVING count_if(kind = 'T') > 0
)
"""
)
