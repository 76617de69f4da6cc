"""Joins, filters, group statistics, rankings and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..operators import explore
from . import sql as Q
from .registry import query
from .tables import clusters, digest, interventions, sessions, speech_lengths, table, vectors

LABELS = list(range(10))


def _full(spark, d):
    full = explore.full_table(clusters(spark, d), interventions(spark, d), sessions(spark, d))
    return explore.with_measures(full)


def _lengths(spark, d):
    """The analysis table with word counts in place of the words: little to shuffle."""
    full = explore.full_table(clusters(spark, d), speech_lengths(spark, d), sessions(spark, d))
    return explore.with_measures(full)


@query(
    "WITH"
    + Q.FULL
    + """
SELECT session_id, date::VARCHAR AS date, chamber, intervention_id, cluster,
       md5(array_to_string(words, ' ')) AS words_md5, len(words)::INT AS num_words, year(date)::INT AS year
FROM full_table
"""
)
def full_table(spark, d):
    return _full(spark, d).select(
        "session_id", F.col("date").cast("string").alias("date"), "chamber", "intervention_id", "cluster",
        digest(F.col("intervention_words")).alias("words_md5"), "num_words", "year",
    )


# --- filters -----------------------------------------------------------------


@query("SELECT vec_id, label AS cluster FROM embeddings WHERE label IN (1, 2, 3, 6, 7, 9)")
def useful_clusters(spark, d):
    return explore.keep_clusters(vectors(spark, d), K.USEFUL_CLUSTERS).select("vec_id", "cluster")


@query("SELECT vec_id, label AS cluster FROM embeddings WHERE label <> 2")
def without_noise(spark, d):
    return explore.drop_clusters(vectors(spark, d), [K.NOISE_CLUSTER]).select("vec_id", "cluster")


@query("SELECT vec_id, label AS cluster FROM embeddings WHERE label NOT IN (0, 4)")
def represented_clusters(spark, d):
    return explore.drop_clusters(vectors(spark, d), K.UNREPRESENTED_CLUSTERS).select("vec_id", "cluster")


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS embedding_1 FROM embeddings WHERE embedding[1] > -0.05")
def coordinate_range(spark, d):
    first = vectors(spark, d).select("vec_id", F.get("vector", F.lit(0)).alias("embedding_1"))
    kept = first.filter(F.col("embedding_1") > -0.05)
    return kept.select("vec_id", F.round("embedding_1", 6).alias("embedding_1"))


@query(
    """
SELECT CASE WHEN ts <= TIMESTAMP '2024-01-20' THEN 'before' ELSE 'after' END AS part, event_type, count(*) AS n
FROM events GROUP BY ALL
"""
)
def cutoff_split(spark, d):
    """Rows up to a date and rows after it."""
    cutoff = F.lit("2024-01-20").cast(table(spark, d, "events").schema["ts"].dataType)
    before, after = explore.split_at(table(spark, d, "events").select("ts", "event_type"), "ts", cutoff)
    parts = before.withColumn("part", F.lit("before")).unionByName(after.withColumn("part", F.lit("after")))
    return parts.groupBy("part", "event_type").agg(F.count(F.lit(1)).alias("n"))


# --- counts and pivots -------------------------------------------------------


@query("SELECT label AS cluster, count(*) AS count FROM embeddings GROUP BY label")
def cluster_counts(spark, d):
    return explore.count_by(vectors(spark, d), "cluster")


@query("SELECT DISTINCT label AS cluster FROM embeddings")
def cluster_labels(spark, d):
    return vectors(spark, d).select("cluster").distinct().orderBy("cluster")


@query("SELECT ts::DATE::VARCHAR AS date, event_type AS cluster, count(*) AS count FROM events GROUP BY ALL")
def date_cluster_counts(spark, d):
    events = table(spark, d, "events")
    dated = events.select(F.to_date("ts").cast("string").alias("date"), F.col("event_type").alias("cluster"))
    return explore.count_by(dated, "date", "cluster")


_PIVOT = ", ".join(f"count_if(cluster = {c})::BIGINT AS cluster_{c}" for c in LABELS)


@query("WITH" + Q.FULL + f"SELECT len(words)::INT AS num_words, {_PIVOT} FROM full_table GROUP BY ALL")
def length_pivot(spark, d):
    return explore.count_pivot(_lengths(spark, d), "num_words", "cluster")


@query("WITH" + Q.FULL + f"SELECT year(date)::INT AS year, {_PIVOT} FROM full_table GROUP BY ALL")
def year_pivot(spark, d):
    return explore.count_pivot(_lengths(spark, d), "year", "cluster")


@query(
    "WITH"
    + Q.FULL
    + "SELECT year(date)::INT AS year, round(avg(len(words)), 6) AS avg_words FROM full_table GROUP BY ALL"
)
def yearly_mean(spark, d):
    means = explore.mean_by(_lengths(spark, d), "year", "num_words", "avg_words")
    return means.select("year", F.round("avg_words", 6).alias("avg_words"))


# --- distribution ------------------------------------------------------------

_DESCRIBE = """
count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v)::DOUBLE, 6) AS min,
round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
round(quantile_cont(v, 0.75), 6) AS q75, round(max(v)::DOUBLE, 6) AS max
"""


def _rounded(described):
    doubles = [c for c, t in described.dtypes if t == "double"]
    return described.withColumns({c: F.round(c, 6) for c in doubles})


@query("WITH" + Q.FULL + f"SELECT cluster, {_DESCRIBE} FROM (SELECT cluster, len(words)::DOUBLE AS v FROM full_table) GROUP BY cluster")
def words_describe(spark, d):
    return _rounded(explore.describe(_lengths(spark, d).select("cluster", "num_words"), "num_words", "cluster"))


@query(f"SELECT {_DESCRIBE} FROM (SELECT embedding[1]::DOUBLE AS v FROM embeddings)")
def coordinate_describe(spark, d):
    first = vectors(spark, d).select(F.get("vector", F.lit(0)).alias("embedding_1"))
    return _rounded(explore.describe(first, "embedding_1"))


@query(
    f"SELECT o_orderpriority, {_DESCRIBE} FROM (SELECT o_orderpriority, o_totalprice AS v FROM orders) GROUP BY o_orderpriority"
)
def price_describe(spark, d):
    """Quartiles of a column with nearly as many values as rows."""
    return _rounded(explore.describe(table(spark, d, "orders"), "o_totalprice", "o_orderpriority"))


@query(
    "WITH"
    + Q.FULL
    + """,
v AS (SELECT len(words)::DOUBLE AS v FROM full_table),
e AS (SELECT min(v) AS lo, max(v) AS hi FROM v)
SELECT least(floor((v - lo) / ((hi - lo) / 100)) + 1, 100)::INT AS bin,
       round(lo + (least(floor((v - lo) / ((hi - lo) / 100)) + 1, 100) - 1) * ((hi - lo) / 100), 6) AS low,
       count(*) AS count
FROM v, e GROUP BY ALL
"""
)
def words_histogram(spark, d):
    bins = explore.histogram(_lengths(spark, d).select("num_words"), "num_words", 100)
    return bins.select("bin", F.round("low", 6).alias("low"), "count")


# --- samples -----------------------------------------------------------------


def _draw(n_sql: str) -> str:
    return f"""
SELECT cluster, vec_id FROM (
  SELECT label AS cluster, vec_id, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM embeddings)
WHERE rn <= {n_sql}
"""


@query(f"SELECT s.cluster, s.vec_id, substr(d.text, 1, 100) AS preview FROM ({_draw('5')}) s JOIN documents d ON d.doc_id = s.vec_id")
def sample_previews(spark, d):
    """Five random speeches per cluster with the start of their text."""
    sample = explore.sample_n(vectors(spark, d).select("vec_id", "cluster"), "cluster", "vec_id", 5)
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return explore.sample_texts(sample, texts, "vec_id", "text").select("cluster", "vec_id", "preview")


@query(f"SELECT cluster, string_agg(vec_id::VARCHAR, ',' ORDER BY vec_id) AS ids FROM ({_draw('5')}) GROUP BY cluster")
def sample_ids(spark, d):
    sample = explore.sample_n(vectors(spark, d).select("vec_id", "cluster"), "cluster", "vec_id", 5)
    lists = explore.ids_by_cluster(sample, "cluster", "vec_id")
    return lists.select("cluster", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(_draw("round_even(0.05 * n, 0)"))
def sample_fraction(spark, d):
    sample = explore.sample_fraction(vectors(spark, d).select("vec_id", "cluster"), "cluster", "vec_id", 0.05)
    return sample.select("cluster", "vec_id")


@query("SELECT doc_id, substr(text, 1, 100) AS preview FROM documents")
def previews(spark, d):
    return table(spark, d, "documents").select("doc_id", X.preview(F.col("text")).alias("preview"))
