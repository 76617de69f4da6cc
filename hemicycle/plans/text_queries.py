"""Session assembly, cleaning, pairing, keywords and tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..functions import tokens as N
from ..operators import assembly, explore, lemma_rules, normalize, segments
from ..session import stored
from . import sql as Q
from .registry import query
from .source_queries import _SENTENCES
from .tables import digest, document_keywords, gazettes, table, turn_spans

# --- assembly and cleaning ---------------------------------------------------


@query(
    """
WITH lines AS (
  SELECT conv_id, turn, role, i, string_split(l[i], ', ') AS spans
  FROM (SELECT conv_id, turn, role, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT *, string_split(text, chr(10)) AS l FROM conversations))
),
line_text AS (
  SELECT conv_id, turn, i, array_to_string(list_transform(spans, lambda s:
         CASE WHEN role = 'user' THEN '*b-*' || s || '*-b* ' ELSE s || ' ' END), '') || chr(10) AS s
  FROM lines
),
blocks AS (
  SELECT conv_id, turn, string_agg(s, '' ORDER BY i) || chr(10) AS s FROM line_text GROUP BY ALL
)
SELECT conv_id AS doc, length(string_agg(s, '' ORDER BY turn)) AS chars, md5(string_agg(s, '' ORDER BY turn)) AS text_md5
FROM blocks GROUP BY conv_id
"""
)
def span_assembly(spark, d):
    text = assembly.assemble_spans(turn_spans(spark, d))
    return text.select("doc", F.length("raw_text").cast("bigint").alias("chars"), F.md5("raw_text").alias("text_md5"))


@query(
    "WITH"
    + Q.cleaned("documents", "doc_id", "text")
    + "SELECT doc_id, length(clean_text) AS chars, md5(clean_text) AS text_md5 FROM cleaned"
)
def clean_documents(spark, d):
    cleaned = table(spark, d, "documents").select("doc_id", X.clean_raw_text(F.col("text")).alias("t"))
    return cleaned.select("doc_id", F.length("t").cast("bigint").alias("chars"), F.md5("t").alias("text_md5"))


@query(
    """
SELECT doc_id, len(kept) AS n_lines, md5(array_to_string(kept, chr(10))) AS text_md5
FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[a-z]')) AS kept FROM documents)
"""
)
def mixed_case_lines(spark, d):
    kept = table(spark, d, "documents").select("doc_id", X.keep_mixed_case_lines(F.col("text")).alias("t"))
    lines = F.when(F.length("t") == 0, 0).otherwise(F.size(F.split("t", "\n")))
    return kept.select("doc_id", lines.cast("bigint").alias("n_lines"), F.md5("t").alias("text_md5"))


@query(
    "WITH"
    + Q.GAZETTES
    + ","
    + Q.cleaned("gazettes", "doc", "raw_text")
    + "SELECT doc, length(clean_text) AS chars, md5(clean_text) AS text_md5 FROM cleaned"
)
def clean_gazettes(spark, d):
    """The whole cleaning chain on texts with masthead, act heading and bold runs."""
    cleaned = gazettes(spark, d).select("doc", X.clean_raw_text(F.col("raw_text")).alias("t"))
    return cleaned.select("doc", F.length("t").cast("bigint").alias("chars"), F.md5("t").alias("text_md5"))


_INFO_SQL = """
  TRY_CAST((doc % 20 + 2000) || '-' || lpad((doc % 12 + 1)::VARCHAR, 2, '0') || '-'
    || lpad((doc % 31 + 1)::VARCHAR, 2, '0') AS DATE)::VARCHAR AS date,
  CASE doc % 3 WHEN 0 THEN 'house' ELSE 'senate' END AS chamber,
  CASE doc % 3 WHEN 1 THEN 'commitee' ELSE 'plenary' END AS type
"""


@query(f"SELECT doc, {_INFO_SQL} FROM (SELECT DISTINCT conv_id AS doc FROM conversations)")
def session_details(spark, d):
    """Date, chamber and type found in cleaned text; a day that does not exist gives null."""
    cleaned = gazettes(spark, d).select("doc", X.clean_raw_text(F.col("raw_text")).alias("t"))
    info = assembly.with_session_info(cleaned, "t")
    return info.select("doc", F.col("date").cast("string").alias("date"), "chamber", "type")


@query("WITH" + Q.PAIRS + "SELECT doc, pair, headline, md5(body) AS body_md5 FROM pairs")
def headline_pairs(spark, d):
    cleaned = gazettes(spark, d).select("doc", X.clean_raw_text(F.col("raw_text")).alias("t"))
    pairs = segments.headline_pairs(cleaned, "doc", "t")
    return pairs.select("doc", F.col("pair").cast("int").alias("pair"), "headline", F.md5("body").alias("body_md5"))


@query(
    "WITH"
    + Q.PAIRS
    + rf""",
tokens AS (SELECT doc, pair, unnest(regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM pairs),
tf AS (SELECT doc, pair, term, count(*) AS tf FROM tokens WHERE term NOT IN ({Q.STOP}) GROUP BY ALL),
dfs AS (SELECT doc, term, count(*) AS df FROM tf GROUP BY ALL),
sizes AS (SELECT doc, count(*) AS n FROM pairs GROUP BY ALL),
weighted AS (
  SELECT doc, pair, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w
  FROM tf JOIN dfs USING (doc, term) JOIN sizes USING (doc)
),
kept AS (
  SELECT doc, pair, term FROM (
    SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc, pair)) AS weight FROM weighted)
  WHERE round(weight, 12) > 0.1
)
SELECT doc AS session_id, {_INFO_SQL}, length(clean_text) AS chars,
       (SELECT count(*) FROM pairs p WHERE p.doc = c.doc)::INT AS n_pairs,
       (SELECT count(*) FROM kept k WHERE k.doc = c.doc)::INT AS n_keywords
FROM cleaned c
"""
)
def session_records(spark, d):
    """Whole session records: info, texts, pairs and keywords of one pass."""
    records = assembly.session_records(gazettes(spark, d), stop_words=K.STOP_WORDS)
    n_keywords = F.aggregate("keywords", F.lit(0), lambda s, k: s + F.size(k))
    return records.select(
        "session_id",
        F.col("date").cast("string").alias("date"),
        "chamber",
        "type",
        F.length("clean_text").cast("bigint").alias("chars"),
        F.size("pairs").alias("n_pairs"),
        n_keywords.alias("n_keywords"),
    )


@query(
    "WITH"
    + Q.KEYWORDS
    + """
SELECT d.source, d.doc_id, coalesce(string_agg(k.term, ' ' ORDER BY k.term), '') AS keywords
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id GROUP BY ALL
"""
)
def tfidf_keywords(spark, d):
    words = document_keywords(spark, d)
    return words.select("source", "doc_id", F.array_join("keywords", " ").alias("keywords"))


# --- tokens ------------------------------------------------------------------


def _token_sql(tokens: str) -> str:
    return (
        "SELECT doc_id, len(w)::INT AS n, md5(array_to_string(w, ' ')) AS tokens_md5 "
        f"FROM (SELECT doc_id, {tokens} AS w FROM documents)"
    )


def _token_rows(df, col):
    return df.select("doc_id", F.size(col).alias("n"), digest(F.col(col)).alias("tokens_md5"))


_SPLIT_WORDS = r"string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')"


@query(_token_sql(f"list_filter({_SPLIT_WORDS}, lambda t: t NOT IN ({Q.STOP}))"))
def basket_tokens(spark, d):
    """Tokenizer and stop-word remover pipeline."""
    documents = table(spark, d, "documents").select("doc_id", "text")
    pipeline = N.basket_pipeline("text").fit(documents)
    return _token_rows(pipeline.transform(documents), "filtered_tokens")


@query(_token_sql(Q.VALID_WORDS))
def valid_words(spark, d):
    words = N.valid_words(N.word_tokens(F.lower("text")))
    return _token_rows(table(spark, d, "documents").select("doc_id", words.alias("w")), "w")


@query(_token_sql(f"list_filter({Q.VALID_WORDS}, lambda t: t NOT IN ({Q.TOP_STOP}))"))
def filtered_words(spark, d):
    """Stop words dropped, repetitions kept."""
    words = N.valid_words(N.word_tokens(F.lower("text")))
    kept = N.without_words(words, K.TOP_WORD_STOP_WORDS)
    return _token_rows(table(spark, d, "documents").select("doc_id", kept.alias("w")), "w")


@query(
    f"""
WITH toks AS (
  SELECT doc_id, t, i FROM (
    SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT doc_id, list_filter({_SPLIT_WORDS}, lambda t: t NOT IN ({Q.STOP})
            AND regexp_full_match(t, '{K.VALID_WORD_PATTERN[1:-1]}')) AS w FROM documents))
),
firsts AS (SELECT doc_id, t, min(i) AS i FROM toks GROUP BY ALL)
SELECT d.doc_id, count(f.t)::INT AS n, md5(coalesce(string_agg(f.t, ' ' ORDER BY f.i), '')) AS tokens_md5
FROM documents d LEFT JOIN firsts f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""
)
def distinct_tokens(spark, d):
    """Item baskets: distinct valid tokens in order of first occurrence."""
    baskets = N.baskets(table(spark, d, "documents").select("doc_id", "text"), "text")
    return _token_rows(baskets, "items")


@query(_token_sql(Q.WORDS.format("text")))
def word_tokens(spark, d):
    return _token_rows(table(spark, d, "documents").select("doc_id", N.word_tokens(F.col("text")).alias("w")), "w")


_CONTENT = (
    "list_filter("
    + Q.WORDS.format("lower(text)")
    + rf", lambda t: t NOT IN ({Q.STOP}, 'artículo') AND NOT regexp_full_match(t, '\p{{N}}+')"
    + f" AND t NOT IN ({Q.quoted(K.NUMBER_WORDS['es'])}))"
)


@query(_token_sql(_CONTENT))
def normalized_tokens(spark, d):
    """Content tokens in surface form, with a caller's own stop word."""
    return _token_rows(
        normalize.normalize_tokens(table(spark, d, "documents"), "doc_id", "text", K.STOP_WORDS, extra_stop=["artículo"]),
        "tokens",
    )


@query(
    f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos
  FROM (SELECT doc_id, {_CONTENT} AS w FROM documents)
),
vocabulary AS (SELECT DISTINCT word FROM words),
lemmas AS (
  SELECT v.word, s.word AS lemma FROM vocabulary v JOIN vocabulary s ON v.word = s.word || 's'
)
SELECT d.doc_id, count(w.word)::INT AS n,
       md5(coalesce(string_agg(coalesce(l.lemma, w.word), ' ' ORDER BY w.pos), '')) AS tokens_md5
FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id LEFT JOIN lemmas l ON l.word = w.word
GROUP BY d.doc_id
"""
)
def lemma_tokens(spark, d):
    """Content tokens as lemmas; the lemma table maps a plural to a singular that occurs."""
    documents = table(spark, d, "documents")
    surface = stored(normalize.normalize_tokens(documents, "doc_id", "text", K.STOP_WORDS, extra_stop=["artículo"]), "surface")
    vocabulary = stored(surface.select(F.explode("tokens").alias("word")).distinct(), "vocabulary")
    singular = vocabulary.select(F.concat("word", F.lit("s")).alias("word"), F.col("word").alias("lemma"))
    lemmas = singular.join(vocabulary, "word", "left_semi")
    return _token_rows(normalize.as_lemmas(surface, "doc_id", stored(lemmas, "lemmas")), "tokens")


# --- lemma rules -------------------------------------------------------------

_MAX_SUFFIX, _MIN_COUNT = 5, 2

_KNOWN_SQL = f"""
vocabulary AS MATERIALIZED (
  SELECT DISTINCT word FROM (SELECT unnest({_CONTENT}) AS word FROM documents)
),
plurals AS MATERIALIZED (
  SELECT word, min(lemma) AS lemma FROM (
    SELECT v.word, s.word AS lemma FROM vocabulary v JOIN vocabulary s ON v.word = s.word || 'es'
    UNION ALL
    SELECT v.word, s.word AS lemma FROM vocabulary v JOIN vocabulary s ON v.word = s.word || 's'
  ) GROUP BY word
),
known AS MATERIALIZED (
  SELECT word, lemma, substr(md5(word), 1, 1) < '8' AS low FROM (
    SELECT word, lemma FROM plurals
    UNION ALL
    SELECT DISTINCT lemma, lemma FROM plurals WHERE lemma NOT IN (SELECT word FROM plurals))
)"""


def _rules_sql(source: str) -> str:
    """The rules of a table of known words, as ``rules_{source}``."""
    return f"""
edits_{source} AS (
  SELECT right(word, n) AS suffix, n, length(word) - p AS cut, substr(lemma, p + 1) AS added FROM (
    SELECT word, lemma, unnest(range(1, least(length(word) - 1, {_MAX_SUFFIX}) + 1)) AS n,
      list_max(list_filter(range(0, least(length(word), length(lemma)) + 1), lambda p: left(word, p) = left(lemma, p))) AS p
    FROM {source})
),
counted_{source} AS (
  SELECT suffix, cut, added, count(*) AS n FROM edits_{source} WHERE cut <= n GROUP BY ALL
),
rules_{source} AS MATERIALIZED (
  SELECT suffix, cut, added FROM (
    SELECT *, row_number() OVER (PARTITION BY suffix ORDER BY n DESC, cut, added) AS place FROM counted_{source})
  JOIN (SELECT suffix, count(*) AS total FROM edits_{source} GROUP BY suffix) USING (suffix)
  WHERE place = 1 AND n >= {_MIN_COUNT} AND 2 * n >= total
)"""


def _ruled_sql(words: str, rules: str) -> str:
    return f"""
SELECT word, left(word, length(word) - r.cut) || r.added AS lemma, r.suffix AS suffix FROM (
  SELECT word, max(ROW(length(suffix), suffix, cut, added)::STRUCT(size BIGINT, suffix VARCHAR, cut BIGINT, added VARCHAR))
         FILTER (cut IS NOT NULL) AS r
  FROM (SELECT word, right(word, n) AS suffix FROM (SELECT word, unnest(range(0, least(length(word) - 1, {_MAX_SUFFIX}) + 1)) AS n FROM {words}))
  LEFT JOIN {rules} USING (suffix) GROUP BY word)"""


def _known_lemmas(spark, d):
    """``vocabulary`` and the lemma table of its plurals in -es or -s; singulars are their own lemmas."""
    surface = normalize.normalize_tokens(table(spark, d, "documents"), "doc_id", "text", K.STOP_WORDS, extra_stop=["artículo"])
    vocabulary = stored(surface.select(F.explode("tokens").alias("word")).distinct(), "vocabulary")
    endings = F.explode(F.array(F.lit("es"), F.lit("s"))).alias("ending")
    formed = vocabulary.select(F.col("word").alias("lemma"), endings).withColumn("word", F.concat("lemma", "ending"))
    plurals = formed.join(vocabulary, "word", "left_semi").groupBy("word").agg(F.min("lemma").alias("lemma"))
    singulars = plurals.select(F.col("lemma").alias("word")).distinct().join(plurals, "word", "left_anti")
    known = plurals.unionByName(singulars.withColumn("lemma", F.col("word")))
    return vocabulary, stored(known, "lemmas")


@query(
    f"""
WITH {_KNOWN_SQL},{_rules_sql("known")},
lacking AS (SELECT word FROM vocabulary WHERE word NOT IN (SELECT word FROM known))
{_ruled_sql("lacking", "rules_known")}
"""
)
def learned_lemmas(spark, d):
    """Lemmas by learnt suffix rules of all words that the lemma table lacks."""
    vocabulary, known = _known_lemmas(spark, d)
    rules = lemma_rules.learn_rules(known, _MAX_SUFFIX, _MIN_COUNT)
    return lemma_rules.rule_lemmas(vocabulary.join(known, "word", "left_anti"), rules, _MAX_SUFFIX)


@query(
    f"""
WITH {_KNOWN_SQL},
low AS (SELECT word, lemma FROM known WHERE low),
high AS (SELECT word, lemma FROM known WHERE NOT low),{_rules_sql("low")},{_rules_sql("high")},
told AS (
  SELECT 'high' AS fold, * FROM ({_ruled_sql("high", "rules_low")})
  UNION ALL
  SELECT 'low' AS fold, * FROM ({_ruled_sql("low", "rules_high")})
)
SELECT fold, coalesce(length(suffix), 0)::INT AS suffix_length, count(*) AS words, count(t.lemma) AS ruled,
       count_if(coalesce(t.lemma = k.lemma, false))::BIGINT AS correct
FROM told t JOIN known k USING (word) GROUP BY ALL
"""
)
def lemma_rule_scores(spark, d):
    """Words of each half of the lemma table against the rules learnt from the other half."""
    _, known = _known_lemmas(spark, d)
    low = F.left(F.md5("word"), F.lit(1)) < "8"
    halves = {"low": known.filter(low), "high": known.filter(~low)}
    told = [
        lemma_rules.rule_lemmas(halves[fold], lemma_rules.learn_rules(halves[other], _MAX_SUFFIX, _MIN_COUNT), _MAX_SUFFIX)
        .withColumn("fold", F.lit(fold))
        .withColumnRenamed("lemma", "told")
        for fold, other in (("low", "high"), ("high", "low"))
    ]
    return (
        told[0].unionByName(told[1])
        .join(known, "word")
        .groupBy("fold", F.coalesce(F.length("suffix"), F.lit(0)).alias("suffix_length"))
        .agg(
            F.count(F.lit(1)).alias("words"),
            F.count("told").alias("ruled"),
            F.count_if(F.coalesce(F.col("told") == F.col("lemma"), F.lit(False))).alias("correct"),
        )
    )


# --- sentences ---------------------------------------------------------------


@query(
    f"SELECT doc_id, len(s)::INT AS n, md5(array_to_string(s, '|')) AS sentences_md5 "
    f"FROM (SELECT doc_id, {_SENTENCES} AS s FROM documents)"
)
def sentences(spark, d):
    parts = table(spark, d, "documents").select("doc_id", N.sentences(F.col("text")).alias("s"))
    return parts.select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "|")).alias("sentences_md5"))


# --- top words ---------------------------------------------------------------


@query(
    f"""
WITH words AS (
  SELECT e.label AS cluster, unnest(list_filter({Q.VALID_WORDS}, lambda t: t NOT IN ({Q.TOP_STOP}))) AS word
  FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id
),
counts AS (SELECT cluster, word, count(*) AS count FROM words GROUP BY ALL)
SELECT cluster, word, count, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY count DESC, word) AS rank FROM counts)
WHERE rank <= 20
"""
)
def top_words_per_cluster(spark, d):
    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster"))
    words = N.without_words(N.valid_words(N.word_tokens(F.lower("text"))), K.TOP_WORD_STOP_WORDS)
    speeches = table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id")
    return explore.top_words(speeches.select("cluster", words.alias("w")), "cluster", "w", 20)
