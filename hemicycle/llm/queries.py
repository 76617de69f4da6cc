"""Corpus queries over the given tables, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    codes, contentsort, fingerprints, hostrules, importance, lines, mixing, packing, repeats, runs, slots, tokencounts,
)
from .common import documents, text_of, words_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


#: Words of a text on DuckDB.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SHARDS = {f"shard-{k:03d}": 1 for k in range(64)}


@query()
def op1_slot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    placed = slots.shard_rows(documents(spark, sf_dir).select("doc_id"), SHARDS)
    return placed.selectExpr("key AS doc_id", "slot", "shard")


def _ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _md5_sql(seed: str, *columns: str) -> str:
    parts = ", ".join([f"'{seed}'", *[f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns]])
    return f"CAST('0x' || substr(md5(concat_ws(':', {parts})), 1, 15) AS BIGINT)"


@query(f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS tokens, {_md5_sql("7", "doc_id")} AS ticket
  FROM documents),
src AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS all_tokens FROM docs GROUP BY source),
total AS (SELECT CAST(sum(all_tokens) AS BIGINT) AS budget FROM src),
shares AS (SELECT list(all_tokens / CAST(budget AS DOUBLE)) AS ps, ln(count(*)) AS h
  FROM src, total WHERE all_tokens > 0),
bisect(k, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT k + 1, CASE WHEN entropy >= 0.999 * h THEN mid ELSE lo END,
    CASE WHEN entropy >= 0.999 * h THEN hi ELSE mid END
  FROM (SELECT k, lo, hi, (lo + hi) / 2 AS mid, h,
      ln(list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2))))
      - (lo + hi) / 2 * list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2) * ln(p)))
        / list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2))) AS entropy
    FROM bisect, shares WHERE k < 30)),
exponent AS (
  SELECT CASE WHEN -list_sum(list_transform(ps, lambda p: p * ln(p))) >= 0.999 * h THEN 1 ELSE lo END AS a
  FROM bisect, shares WHERE k = 30),
weights AS (SELECT source, all_tokens, pow(all_tokens / CAST(budget AS DOUBLE), a) AS w, budget
  FROM src, total, exponent),
targets AS (SELECT source, all_tokens, CASE WHEN all_tokens > 0 THEN
    CAST(round(w / sum(CASE WHEN all_tokens > 0 THEN w END) OVER () * CAST(budget AS DOUBLE)) AS BIGINT)
    ELSE 0 END AS target FROM weights),
plan AS (SELECT source, all_tokens, target,
    CASE WHEN all_tokens > 0 THEN target // all_tokens ELSE 1 END AS epochs,
    CASE WHEN all_tokens > 0 THEN target % all_tokens ELSE 0 END AS rest FROM targets),
blocks AS (SELECT greatest(1, CAST(ceil(sum(target) / 1048576.0) AS BIGINT)) AS n_blocks FROM plan),
drawn AS (SELECT doc_id, d.source, tokens, all_tokens, target, epochs, rest,
    sum(tokens) OVER (PARTITION BY d.source ORDER BY ticket RANGE UNBOUNDED PRECEDING) AS until_,
    sum(tokens) OVER (PARTITION BY d.source ORDER BY ticket, doc_id, tokens ROWS UNBOUNDED PRECEDING) - tokens AS begin_
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
copies AS (SELECT *, unnest(range(epochs + CASE WHEN rest > 0 AND until_ <= rest THEN 1 ELSE 0 END)) AS copy FROM drawn)
SELECT doc_id, source, tokens AS n_tokens, copy,
  least(CAST(floor(CAST(copy * all_tokens + begin_ AS DOUBLE) / greatest(target, 1) * n_blocks) AS BIGINT),
    n_blocks - 1) AS block,
  {_md5_sql("7:order", "copy", "doc_id")} AS ticket
FROM copies, blocks
""")
def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as often as a nearly even mix of the sources reads them, as many tokens as the table has."""
    return mixing.mixed_copies(documents(spark, sf_dir), mixing.Mix(entropy_share=0.999, budget=mixing.ALL))


@query(r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
r AS (SELECT doc_id, content, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
    row_number() OVER w AS place
  FROM d WINDOW w AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM r
""")
def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    return contentsort.exact_duplicates(documents(spark, sf_dir))


@query(rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents),
windows AS (SELECT row_, pos, [w[pos], w[pos + 1], w[pos + 2]] AS three
  FROM (SELECT row_, w, unnest(range(1, len(w) - 1)) AS pos FROM (SELECT row_number() OVER () AS row_, w FROM d))),
twice AS (SELECT row_, pos FROM windows QUALIFY count(*) OVER (PARTITION BY row_, three) > 1),
covered AS (SELECT row_, count(DISTINCT pos + k) AS n FROM twice, range(3) r(k) GROUP BY row_),
m AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    row_number() OVER () AS row_ FROM d),
j AS (SELECT m.* EXCLUDE (lines), CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM m LEFT JOIN covered USING (row_)),
f AS (SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repetitive,
    100 * n_symbols > 10 * n_words AS symbols, 100 * n_dup_lines > 30 * greatest(n_lines, 1) AS dup_lines FROM j),
h AS (SELECT source, rule, sum(CAST(bad AS INT)) AS fails, count(*) AS n
  FROM (UNPIVOT f ON short, repetitive, symbols, dup_lines INTO NAME rule VALUE bad) GROUP BY source, rule),
prior AS (SELECT rule, avg(fails / n) AS mean, var_pop(fails / n) AS var FROM h GROUP BY rule),
rates AS (SELECT source, CASE WHEN var = 0 THEN mean ELSE
    (fails + mean * greatest(0, mean * (1 - mean) / var - 1)) / (n + greatest(0, mean * (1 - mean) / var - 1)) END AS rate
  FROM h JOIN prior USING (rule)),
bad AS (SELECT source FROM rates GROUP BY source HAVING max(rate) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
  NOT (short OR repetitive) AND NOT EXISTS (SELECT 1 FROM bad b WHERE b.source IS NOT DISTINCT FROM f.source) AS kept
FROM f
""")
def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and whether it and its host pass."""
    return hostrules.quality_rules(documents(spark, sf_dir))


@query()
def op2_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return fingerprints.near_duplicates(documents(spark, sf_dir))


@query()
def op7_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), _ranks()).drop("ids")


@query()
def op9_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, from flat token files."""
    return tokencounts.token_counts(documents(spark, sf_dir), _ranks())


@query()
def op5_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeated strings of 400 bytes cover."""
    rest = repeats.remove_repeated_bytes(documents(spark, sf_dir))
    return rest.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query()
def op10_doubled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeated windows of 35 words cover."""
    rest = repeats.remove_repeated_words(documents(spark, sf_dir))
    return rest.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query()
def op6_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; as many are kept as the share of good ones among the labelled."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    good = labels.where("quality = 1").select("doc_id")
    share = labels.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    return importance.importance_sample(documents(spark, sf_dir), good, 1.0 if share is None else share)


def _planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in every tenth document, by a hash of its id, words from some place on go round a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = words_of(text_of("text"))
    chosen = docs.select("doc_id", text_of("text").alias("text"), g.alias("g"), F.when(h % 10 == 0, words).alias("w"))
    chosen = chosen.withColumn("n", F.size("w").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, null)"))
    chosen = chosen.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    turned = F.expr(
        "concat_ws(' ', slice(w, 1, int(a)), slice(flatten(array_repeat(slice(w, int(a) + 1, int(p)), int((n - a + p - 1) div p))), 1, int(n - a)))"
    )
    return chosen.select("doc_id", F.when(F.col("n") > 0, turned).otherwise(F.col("text")).alias("text"))


#: CRC-32 of a decimal id on DuckDB, bit by bit.
CRC_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda c, b: list_reduce(list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])),
    lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w, {CRC_SQL} AS h FROM documents),
s AS (SELECT r, doc_id, w, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS turned FROM d),
t AS (SELECT r, doc_id, n, CASE WHEN turned THEN list_transform(range(n), lambda i: CASE WHEN i < g % n THEN w[i + 1]
    ELSE w[g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) + 1] END) ELSE w END AS w FROM s),
words AS (SELECT r, unnest(range(n)) AS i, unnest(w) AS v FROM t),
periods AS (SELECT r, n, unnest(range(1, n // 4 + 1)) AS q FROM t),
grid AS (SELECT r, q, k, v FROM (SELECT r, q, unnest(range((n - 1) // q + 1)) AS k FROM periods) p JOIN words USING (r) WHERE i = k * q),
met AS (SELECT DISTINCT r, q FROM (SELECT r, q, v, lead(v, 1) OVER o AS v1, lead(v, 2) OVER o AS v2, lead(v, 3) OVER o AS v3
    FROM grid WINDOW o AS (PARTITION BY r, q ORDER BY k)) WHERE v = v1 AND v = v2 AND v = v3),
same AS (SELECT a.r, q, a.i AS x FROM met JOIN words a USING (r) JOIN words b ON b.r = a.r AND b.i = a.i + q AND b.v = a.v),
isles AS (SELECT r, q, min(x) AS start, count(*) + q AS length
  FROM (SELECT *, x - row_number() OVER (PARTITION BY r, q ORDER BY x) AS isle FROM same) GROUP BY r, q, isle),
found AS (SELECT r, start, length, min(q) AS period FROM isles WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
lists AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    first(ROW(start, length, period) ORDER BY length DESC, start, period) AS best FROM found GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM found),
rest AS (SELECT r, string_agg(v, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[1] AS start, best[2] AS length, best[3] AS period,
  1000 * best[2] // best[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN lists USING (r) LEFT JOIN rest USING (r)
""")
def op11_recompressed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, with runs planted in every tenth."""
    return runs.digests(runs.document_runs(_planted(documents(spark, sf_dir))))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Every round as two tables: nearest entries by all distances, then floored means."""
    steps = [f"""
k AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS r,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS ints
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, vec_id, label, part, ints[part * len(ints) // {parts} + 1 : (part + 1) * len(ints) // {parts}] AS x
  FROM k, range({parts}) t(part)),
book0 AS (SELECT part, r - 1 AS entry, x AS e FROM p WHERE r <= {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS (SELECT r, part, min(ROW(d, entry)) AS best FROM (
    SELECT r, p.part, entry, list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM p JOIN book{n} b ON b.part = p.part) GROUP BY r, part)""")
        if n < rounds:
            steps.append(f"""
mean{n} AS (SELECT part, entry, list(m ORDER BY i) AS e FROM (
    SELECT part, entry, i, CAST(floor(sum(v) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS m FROM (
      SELECT p.part, best[2] AS entry, unnest(range(len(x))) AS i, unnest(x) AS v FROM p JOIN near{n} USING (r, part))
    GROUP BY part, entry, i) GROUP BY part, entry),
book{n + 1} AS (SELECT part, entry, coalesce(m.e, b.e) AS e FROM book{n} b LEFT JOIN mean{n} m USING (part, entry))""")
    return f"""WITH {",".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN k USING (r)"""


@query(_codes_sql())
def op12_bounded_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: four parts of 256 entries, four rounds."""
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return codes.code_table(*codes.vector_codes(vectors))


@query(r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
s AS (SELECT r, doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM d),
l AS (SELECT *, translate(regexp_replace(line, '^[ 	-
]+|[ 	-
]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM s),
c AS (SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5),
j AS (SELECT r, l.doc_id, i, line, c.key IS NOT NULL AND l.doc_id IS DISTINCT FROM keeper AS gone FROM l LEFT JOIN c ON l.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r
""")
def op13_twice_seen_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document but those that five documents or more hold."""
    rest = lines.drop_common_lines(documents(spark, sf_dir))
    return rest.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
