"""Sources, sinks, listing pages and literals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import literals, vectors
from ..functions import tokens as N
from ..operators import explore, interventions, listing
from ..session import scratch_path
from ..sources import readers, writers
from .registry import query
from .tables import digest, table

_DOCUMENT_DIGEST = "SELECT doc_id, lang, source, n_chars, length(text) AS text_chars, md5(text) AS text_md5 FROM documents"


@query(_DOCUMENT_DIGEST)
def csv_roundtrip(spark, d):
    """Typed CSV scan of what the CSV sink wrote."""
    path = scratch_path(spark, "documents-csv")
    documents = table(spark, d, "documents")
    writers.write_csv(documents, path)
    back = readers.read_session_csv(spark, path, documents.schema)
    return back.select(
        "doc_id", "lang", "source", "n_chars", F.length("text").cast("bigint").alias("text_chars"), F.md5("text").alias("text_md5")
    )


@query("SELECT doc_id::VARCHAR AS doc_id, quality::VARCHAR AS quality, toxic::VARCHAR AS toxic FROM labels")
def csv_text_scan(spark, d):
    """All-text CSV scan with the index column dropped."""
    path = scratch_path(spark, "labels-csv")
    writers.write_csv(table(spark, d, "labels").withColumn("index", F.lit(0)).select("index", "*"), path)
    return readers.read_text_csv(spark, path, index_col=True).select("doc_id", "quality", "toxic")


@query(
    "SELECT vec_id, label, len(embedding)::INT AS dim, round(list_sum(embedding::DOUBLE[]), 6) AS total, "
    "(SELECT count(*) FROM embeddings) AS written FROM embeddings"
)
def parquet_roundtrip(spark, d):
    """Labelled vectors written without a collect, with the row count observed on the way."""
    path = scratch_path(spark, "vectors")
    written = writers.write_table(table(spark, d, "embeddings"), path)
    values = F.col("embedding").cast("array<double>")
    return readers.read_table(spark, path).select(
        "vec_id",
        "label",
        F.size("embedding").alias("dim"),
        F.round(F.aggregate(values, F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
        F.lit(written).cast("bigint").alias("written"),
    )


@query(
    """
SELECT doc_id, array_to_string(list_filter([
         CASE WHEN NOT regexp_matches(text, '[a-z]') THEN 'no lower case' END,
         CASE WHEN length(trim(text)) < 200 THEN 'short' END,
         CASE WHEN text NOT LIKE '%.%' THEN 'no sentence' END], lambda p: p IS NOT NULL), ', ') AS problems
FROM documents
WHERE NOT regexp_matches(text, '[a-z]') OR length(trim(text)) < 200 OR text NOT LIKE '%.%'
"""
)
def reject_split(spark, d):
    """Documents that fail a check, with the checks they fail."""
    text = F.col("text")
    _, rejects = readers.split_rejects(
        table(spark, d, "documents"),
        {
            "no lower case": ~text.rlike("[a-z]"),
            "short": F.length(F.trim("text")) < 200,
            "no sentence": ~text.contains("."),
        },
    )
    return rejects.select("doc_id", F.array_join("problems", ", ").alias("problems"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def landed_anti_join(spark, d):
    """Documents of the listing that are not stored yet."""
    listed = table(spark, d, "documents").select("doc_id", "source")
    return explore.not_landed(listed, table(spark, d, "labels"), "doc_id")


# --- listing pages -----------------------------------------------------------

_ROW = r"(<li><a href=\"[^\"]*\">[^<]*</a></li>)"
_FIELDS = {"raw_id": r">([^<]+)</a>", "date": r"href=\"/([^\"]+)\""}

_LISTING_SQL = r"""
WITH RECURSIVE found AS (
  SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS rows FROM pages
),
listing AS (
  SELECT page_id, pos - 1 AS pos, regexp_extract(rows[pos], '>([^<]+)</a>', 1) AS raw_id,
         regexp_extract(rows[pos], 'href="/([^"]+)"', 1) AS date
  FROM (SELECT page_id, rows, unnest(range(1, len(rows) + 1)) AS pos FROM found)
),
valid AS (
  SELECT *, CASE WHEN page_id % 2 = 0 THEN 'Cámara de Representantes' ELSE 'Senado' END AS chamber
  FROM listing WHERE raw_id <> '' AND date <> ''
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS k FROM valid),
fold(page_id, k, session_id, used) AS (
  SELECT page_id, k, 'gaceta_' || raw_id, ['gaceta_' || raw_id] FROM ranked WHERE k = 1
  UNION ALL
  SELECT page_id, k, session_id, list_append(used, session_id) FROM (
    SELECT r.page_id, r.k, f.used, CASE WHEN NOT list_contains(f.used, 'gaceta_' || raw_id) THEN 'gaceta_' || raw_id
      ELSE list_filter(list_transform(range(1, len(f.used) + 2), lambda n: 'gaceta_' || raw_id || ' (' || n || ')'),
        lambda x: NOT list_contains(f.used, x))[1] END AS session_id
    FROM fold f JOIN ranked r ON r.page_id = f.page_id AND r.k = f.k + 1)
),
named AS (SELECT r.* EXCLUDE (k), f.session_id FROM ranked r JOIN fold f USING (page_id, k))
"""


def _listing(spark, d):
    rows = listing.listing_rows(table(spark, d, "pages"), "page_id", "html", _ROW, _FIELDS)
    chamber = F.when(F.col("page_id") % 2 == 0, "Cámara de Representantes").otherwise("Senado")
    return rows.withColumn("chamber", chamber)


@query(_LISTING_SQL + "SELECT page_id, pos::INT AS pos, raw_id, date, chamber FROM valid")
def listing_rows(spark, d):
    return _listing(spark, d).select("page_id", "pos", "raw_id", "date", "chamber")


@query(_LISTING_SQL + "SELECT page_id, pos::INT AS pos, raw_id FROM valid WHERE contains(raw_id, 'en')")
def listing_search(spark, d):
    """Rows that mention a search word."""
    return listing.mentions(_listing(spark, d), "raw_id", "en").select("page_id", "pos", "raw_id")


@query(_LISTING_SQL + "SELECT page_id, pos::INT AS pos, session_id FROM named")
def listing_unique_ids(spark, d):
    named = listing.unique_ids(_listing(spark, d), "page_id", "pos", "raw_id")
    return named.select("page_id", "pos", "session_id")


@query(
    _LISTING_SQL
    + """
SELECT session_id, date, CASE WHEN contains(chamber, 'Cámara') THEN 'house' ELSE 'senate' END AS chamber
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY page_id DESC, pos DESC) AS rn FROM named)
WHERE rn = 1
"""
)
def listing_sessions(spark, d):
    """Session info with later pages overwriting earlier ones."""
    return listing.session_info(_listing(spark, d), "page_id", "pos").select("session_id", "date", "chamber")


# --- interventions and literals ----------------------------------------------

_SENTENCES = r"""
list_filter(list_transform(string_split(regexp_replace(text, '([.!?…])[ \t\n\r\f]+', '\1' || chr(1), 'g'), chr(1)),
  lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))), lambda s: length(s) > 0)
"""


@query(
    f"""
SELECT source AS session, count(*) AS interventions, count(*) AS distinct_ids, sum(length(s))::BIGINT AS chars
FROM (SELECT source, unnest({_SENTENCES}) AS s FROM documents) GROUP BY source
"""
)
def explode_interventions(spark, d):
    """One row per sentence with a stable id, summed up per session."""
    documents = table(spark, d, "documents").select("doc_id", "source", N.sentences(F.col("text")).alias("interventions"))
    exploded = interventions.explode_interventions(documents, session="doc_id", keep=["source"])
    return (
        exploded.groupBy(F.col("source").alias("session"))
        .agg(
            F.count(F.lit(1)).alias("interventions"),
            F.countDistinct("int_id").alias("distinct_ids"),
            F.sum(F.length("intervention")).alias("chars"),
        )
    )


_LINE_WORDS = r"""list_transform(string_split(text, chr(10)), lambda l: '[' || array_to_string(
  list_transform(regexp_extract_all(l, '[\p{L}\p{N}]+'), lambda w: '''' || w || ''''), ', ') || ']')"""


def _nested_literal(text):
    lines = F.transform(F.split(text, "\n"), lambda line: literals.words_literal(N.word_tokens(line)))
    return F.concat(F.lit("["), F.array_join(lines, ", "), F.lit("]"))


@query(
    f"""
SELECT doc_id AS session, intervention, count(*) AS n
FROM (SELECT doc_id, unnest(string_split(regexp_replace(
        '[' || array_to_string({_LINE_WORDS}, ', ') || ']', '^\\[|\\]$', '', 'g'), '], [')) AS intervention
      FROM documents)
GROUP BY ALL
"""
)
def legacy_interventions(spark, d):
    """Nested list literals split the legacy way."""
    literal = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), _nested_literal(F.col("text")).alias("interventions")
    )
    exploded = interventions.explode_legacy(literal)
    return exploded.groupBy("session", "intervention").agg(F.countDistinct("int_id").alias("n"))


@query(
    r"""
SELECT doc_id, len(w)::INT AS n_words, md5(array_to_string(w, ' ')) AS words_md5
FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS w FROM documents)
"""
)
def parse_words(spark, d):
    """List-of-strings literals read back to arrays."""
    literal = literals.words_literal(N.word_tokens(F.col("text")))
    parsed = table(spark, d, "documents").select("doc_id", literal.alias("l")).select(
        "doc_id", literals.parse_words(F.col("l")).alias("w")
    )
    return parsed.select("doc_id", F.size("w").alias("n_words"), digest(F.col("w")).alias("words_md5"))


@query(
    """
SELECT vec_id, dialect, len(embedding)::INT AS dim, round(embedding[1]::DOUBLE, 9) AS first,
       round(list_sum(embedding::DOUBLE[]), 6) AS total
FROM embeddings, (VALUES ('comma'), ('json'), ('space')) AS t(dialect)
"""
)
def parse_vectors(spark, d):
    """Three dialects of vector literals read back to arrays."""
    values = F.col("embedding").cast("array<double>")
    parts = F.transform(values, lambda x: x.cast("string"))
    text = table(spark, d, "embeddings").select(
        "vec_id",
        F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]")).alias("comma"),
        F.concat(F.lit("["), F.array_join(parts, "  "), F.lit("\n]")).alias("space"),
    )
    dialects = F.array(
        F.struct(F.lit("comma").alias("dialect"), vectors.parse_vector(F.col("comma")).alias("v")),
        F.struct(F.lit("space").alias("dialect"), vectors.parse_vector(F.col("space")).alias("v")),
        F.struct(F.lit("json").alias("dialect"), vectors.parse_json_vector(F.col("comma")).alias("v")),
    )
    return text.select("vec_id", F.inline(dialects)).select(
        "vec_id",
        "dialect",
        F.size("v").alias("dim"),
        F.round(F.get("v", F.lit(0)), 9).alias("first"),
        F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
    )


@query(
    """
SELECT vec_id, round(embedding[1]::DOUBLE, 4) AS embedding_1, round(embedding[2]::DOUBLE, 4) AS embedding_2
FROM embeddings
"""
)
def vector_columns(spark, d):
    """Decimal numbers found in text, the first two as columns."""
    printed = F.transform("embedding", lambda x: F.format_string("%.9f", x.cast("double")))
    found = vectors.find_floats(F.array_join(printed, " "))
    return table(spark, d, "embeddings").select("vec_id", found.alias("v")).select(
        "vec_id",
        F.round(F.get("v", F.lit(0)), 4).alias("embedding_1"),
        F.round(F.get("v", F.lit(1)), 4).alias("embedding_2"),
    )


@query("SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY label")
def label_from_name(spark, d):
    """Labels read from model file names."""
    name = F.concat(F.lit("cluster_"), F.col("label"), F.lit("_n2v.model"))
    labels = table(spark, d, "embeddings").select(literals.label_from_name(name).alias("cluster"))
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
