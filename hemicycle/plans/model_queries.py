"""Dimension reduction, clustering, representatives and patterns."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.vectors import norm, to_vector
from ..operators import closed_sets as S
from ..operators import clusters as C
from ..operators import features as L
from ..operators import representatives as R
from ..operators import splitting as X
from ..session import stored
from . import sql as Q
from .registry import query
from .tables import labelled_keywords, table, vectors

# --- dimension reduction -----------------------------------------------------


def _featured(spark, d):
    return vectors(spark, d).withColumn("features", to_vector(F.col("vector")))


def _dimension(df):
    return len(df.select("vector").first()[0])


@query()
def pca_variance(spark, d):
    df = _featured(spark, d)
    model, _ = L.fit_pca(df, "features", _dimension(df))
    table_ = L.variance_table(spark, L.explained_variance(model))
    return table_.select("component", F.round("ratio", 6).alias("ratio"), F.round("cumulative", 6).alias("cumulative"))


@query(
    "WITH"
    + Q.COORDS
    + """,
means AS (SELECT i, avg(x) AS m FROM coords GROUP BY i),
centred AS (SELECT vec_id, i, x - m AS x FROM coords JOIN means USING (i)),
cov AS (
  SELECT a.i, b.i AS j, sum(a.x * b.x) AS c FROM centred a JOIN centred b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
)
SELECT count_if(i = j)::INT AS components, 1.0::DOUBLE AS ratio_sum,
       round(sum(c * c) / (sum(CASE WHEN i = j THEN c ELSE 0 END) ^ 2), 6) AS ratio_square_sum
FROM cov
"""
)
def pca_moments(spark, d):
    """Sum and sum of squares of the explained-variance ratios, which fix the spectrum's spread."""
    df = _featured(spark, d)
    model, _ = L.fit_pca(df, "features", _dimension(df))
    ratios = L.variance_table(spark, L.explained_variance(model))
    return ratios.agg(
        F.count("ratio").cast("int").alias("components"),
        F.round(F.sum("ratio"), 6).alias("ratio_sum"),
        F.round(F.sum(F.col("ratio") * F.col("ratio")), 6).alias("ratio_square_sum"),
    )


@query()
def components_for_share(spark, d):
    """Components that reach (and that exceed) 90 % of the variance."""
    df = _featured(spark, d)
    model, _ = L.fit_pca(df, "features", _dimension(df))
    ratios = L.explained_variance(model)
    totals = L.variance_table(spark, ratios)
    reached = totals.agg(F.min(F.when(F.col("cumulative") >= 0.9, F.col("component"))).alias("at_least"))
    return reached.withColumn("more_than", F.lit(L.components_for(ratios, 0.9, strict=True)))


@query(
    "WITH"
    + Q.COORDS
    + """,
means AS (SELECT i, avg(x) AS m FROM coords GROUP BY i)
SELECT vec_id, round(sum((x - m) * (x - m)), 6) AS squared_norm FROM coords JOIN means USING (i) GROUP BY vec_id
"""
)
def pca_projection(spark, d):
    """All centred component scores; a rotation keeps each row's distance from the mean."""
    df = _featured(spark, d)
    k = _dimension(df)
    model, centred = L.fit_pca(df, "features", k)
    scores = L.pca_project(model, centred, k)
    length = norm(vector_to_array("pca_features"))
    return scores.select("vec_id", F.round(length * length, 6).alias("squared_norm"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS squared_norm FROM embeddings")
def svd_scores(spark, d):
    """All SVD scores (U sigma); a rotation keeps each row's length."""
    df = vectors(spark, d)
    scored = L.svd_scores(df, "vector", L.fit_svd(df, "vector", _dimension(df)))
    return scored.select("vec_id", F.round(norm(F.col("svd")) * norm(F.col("svd")), 6).alias("squared_norm"))


def _axes(scores, vector, k):
    """Number of score columns, spread of their squares, worst pair of columns, and whether they fall."""
    products = L.gram_rows(scores, vector).filter(F.col("i") < k)
    square = F.get("row", F.col("i"))
    others = F.transform("row", lambda x, j: F.when((j != F.col("i")) & (j < k), F.abs(x)).otherwise(0.0))
    found = products.select("i", square.alias("square"), F.array_max(others).alias("pair"))
    falling = F.transform(F.sort_array(F.collect_list(F.struct("i", "square"))), lambda e: e["square"])
    steps = F.transform(falling, lambda x, j: F.coalesce(F.get(falling, j + 1) <= x * (1 + 1e-9), F.lit(True)))
    return found.agg(
        F.count("i").cast("int").alias("columns"),
        F.round(F.sum(F.col("square") * F.col("square")) / F.pow(F.sum("square"), F.lit(2)), 6).alias("spread"),
        F.round(F.max("pair") / F.max("square"), 6).alias("worst_pair"),
        F.forall(steps, lambda ok: ok).alias("falling"),
    )


_AXES = """
SELECT count_if(i = j)::INT AS columns, round(sum(c * c) / (sum(CASE WHEN i = j THEN c ELSE 0 END) ^ 2), 6) AS spread,
       0.0::DOUBLE AS worst_pair, TRUE AS falling
FROM products
"""


@query(
    "WITH"
    + Q.COORDS
    + """,
means AS (SELECT i, avg(x) AS m FROM coords GROUP BY i),
centred AS (SELECT vec_id, i, x - m AS x FROM coords JOIN means USING (i)),
products AS (
  SELECT a.i, b.i AS j, sum(a.x * b.x) AS c FROM centred a JOIN centred b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
)"""
    + _AXES
)
def pca_axes(spark, d):
    """PCA scores are uncorrelated, fall in variance, and keep the squared norm of the covariance.

    Only the right rotation does: any other leaves pairs of columns that vary together.
    """
    df = _featured(spark, d)
    k = _dimension(df)
    model, centred = L.fit_pca(df, "features", k)
    scores = L.pca_project(model, centred, k).select(vector_to_array("pca_features").alias("scores"))
    return _axes(scores, "scores", k)


@query(
    "WITH"
    + Q.COORDS
    + """,
products AS (
  SELECT a.i, b.i AS j, sum(a.x * b.x) AS c FROM coords a JOIN coords b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
)"""
    + _AXES
)
def svd_axes(spark, d):
    """SVD scores are orthogonal, fall in length, and keep the squared norm of the Gram matrix."""
    df = vectors(spark, d)
    k = _dimension(df)
    return _axes(L.svd_scores(df, "vector", L.fit_svd(df, "vector", k)), "svd", k)


@query(
    """
SELECT i::INT AS component, 1.0::DOUBLE AS squared_length
FROM (SELECT DISTINCT unnest(range(0, len(embedding))) AS i FROM embeddings)
"""
)
def svd_left(spark, d):
    """Left singular vectors: every column has length one."""
    df = vectors(spark, d)
    scored = L.svd_scores(df, "vector", L.fit_svd(df, "vector", _dimension(df)), scaled=False)
    entries = scored.select(F.posexplode("svd").alias("component", "u"))
    return entries.groupBy("component").agg(F.round(F.sum(F.col("u") * F.col("u")), 6).alias("squared_length"))


@query()
def plot_coordinates(spark, d):
    xy = L.plot_coordinates(vectors(spark, d), "vector")
    return xy.select("vec_id", "cluster", F.round("embedding_1", 6).alias("embedding_1"), F.round("embedding_2", 6).alias("embedding_2"))


# --- clustering --------------------------------------------------------------


def _sizes(labelled):
    return labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query()
def kmeans_labels(spark, d):
    return _sizes(C.fit_clusters(_featured(spark, d).drop("cluster"), "kmeans", 5))


@query()
def gmm_labels(spark, d):
    """Gaussian mixture on ten principal components."""
    model, centred = L.fit_pca(_featured(spark, d).drop("cluster"), "features", 10)
    return _sizes(C.fit_clusters(L.pca_project(model, centred, 10), "gmm", 5, "pca_features"))


@query(
    "WITH"
    + Q.COORDS
    + """,
norms AS (SELECT vec_id, any_value(cluster) AS cluster, sum(x * x) AS q FROM coords GROUP BY vec_id),
totals AS (SELECT cluster, i, sum(x) AS s FROM coords GROUP BY cluster, i),
sizes AS (SELECT cluster, count(*) AS n, sum(q) AS psi FROM norms GROUP BY cluster),
products AS (
  SELECT c.vec_id, t.cluster AS other, sum(c.x * t.s) AS dot FROM coords c JOIN totals t USING (i) GROUP BY ALL
),
dist AS (
  SELECT p.vec_id, n.cluster, p.other, z.n,
         CASE WHEN p.other = n.cluster THEN (z.n * n.q + z.psi - 2 * dot) / nullif(z.n - 1, 0)
              ELSE (z.n * n.q + z.psi - 2 * dot) / z.n END AS d
  FROM products p JOIN norms n USING (vec_id) JOIN sizes z ON z.cluster = p.other
),
s AS (
  SELECT vec_id, max(CASE WHEN other = cluster THEN d END) AS a, min(CASE WHEN other <> cluster THEN d END) AS b
  FROM dist GROUP BY vec_id
)
SELECT round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM s
"""
)
def label_silhouette(spark, d):
    """Squared-Euclidean silhouette of the given labels."""
    df = _featured(spark, d).withColumn("cluster", F.col("cluster").cast("double"))
    score = C.silhouette(df)
    return df.agg(F.round(F.lit(score), 6).alias("silhouette"), F.count(F.lit(1)).alias("_n")).drop("_n")


@query(
    """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
sums AS (
  SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS total, count(*) AS n
  FROM e a, e b GROUP BY ALL
),
s AS (
  SELECT vec_id, label, max(CASE WHEN label = other THEN total / (n - 1) END) AS a,
         min(CASE WHEN label <> other THEN total / n END) AS b
  FROM sums GROUP BY ALL
)
SELECT label AS cluster, count(*) AS n, round(avg((b - a) / greatest(a, b)), 5) AS silhouette FROM s GROUP BY label
"""
)
def euclidean_silhouette(spark, d):
    """Plain Euclidean silhouette of the given labels, averaged per cluster."""
    scored = C.silhouette_euclidean(vectors(spark, d), "vector", "vec_id")
    return scored.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("silhouette"), 5).alias("silhouette")
    )


@query()
def cluster_sweep(spark, d):
    """Scores of both algorithms over cluster counts and feature sets."""
    df = _featured(spark, d).drop("cluster")
    model, centred = L.fit_pca(df, "features", 10)
    reduced = L.pca_project(model, centred, 10)
    svd = L.fit_svd(reduced, "vector", 10)
    scored = L.svd_scores(reduced, "vector", svd).withColumn("svd_features", to_vector(F.col("svd")))
    counts = [3, 4, 5, 6, 7, 10]
    # A mixture has a covariance matrix per component, too many numbers for the raw width.
    raw = C.sweep(scored, ["features"], counts, ["kmeans"])
    both = raw.unionByName(C.sweep(scored, ["pca_features", "svd_features"], counts))
    return both.orderBy(F.desc("silhouette"), "algorithm", "features", "k")


@query()
def two_round_labels(spark, d):
    """Label, drop the noise cluster, reduce and label again."""
    labelled = C.two_rounds(vectors(spark, d).drop("cluster"), "vector", K.NOISE_CLUSTER)
    return _sizes(labelled)


@query()
def final_labels(spark, d):
    """Ten clusters on SVD scores; as many components as the vectors allow, 172 at most."""
    df = vectors(spark, d).drop("cluster")
    return _sizes(C.reduce_and_label(df, "vector", 10, components=min(172, _dimension(df))))


# --- all cluster counts at once ----------------------------------------------

#: Largest cluster count of the sweep, and passes that refine all sets together.
SPLIT_K, SPLIT_ROUNDS = 10, 10


def _split_sql(max_k: int, rounds: int) -> str:
    """CTEs of the passes: ``s{t}`` holds the centres before pass ``t``, ``u{t}`` the sums of their clusters.

    The last ``a{t}`` assigns the rows to the final centres.
    """
    last = max_k - 1 + rounds
    parts = [
        """
e AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
s0 AS MATERIALIZED (
  SELECT 1 AS k, 0 AS c, list(m ORDER BY i) AS centre
  FROM (SELECT i, avg(v[i]) AS m FROM (SELECT v, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY i)
)"""
    ]
    for t in range(last + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (
  SELECT vec_id, v, k, arg_min(c, ROW(d, c)) AS c, min(d) AS d
  FROM (SELECT vec_id, v, k, c, list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - centre[i]) ** 2)) AS d
        FROM e, s{t})
  GROUP BY vec_id, v, k
),
w{t} AS MATERIALIZED (
  SELECT k, c, i, n, m, q - n * m * m AS scatter, CASE WHEN n > 0 THEN m END AS mean FROM (
    SELECT k, c, i, count(*) AS n, avg(v[i]) AS m, sum(v[i] * v[i]) AS q
    FROM (SELECT k, c, v, unnest(range(1, len(v) + 1)) AS i FROM a{t}) GROUP BY k, c, i)
)""")
        if t == last:
            break
        grow = t + 1 < max_k
        parts.append(f"""
m{t} AS MATERIALIZED (
  SELECT s.k, s.c, coalesce(n.centre, s.centre) AS centre
  FROM s{t} s LEFT JOIN (SELECT k, c, list(m ORDER BY i) AS centre FROM w{t} GROUP BY k, c) n USING (k, c)
),
s{t + 1} AS MATERIALIZED (
  SELECT k, c, centre FROM m{t}""" + (f"""
  UNION ALL
  SELECT k + 1, CASE WHEN side = 1 THEN k ELSE m.c END,
         CASE WHEN m.c = b.c THEN list_transform(range(1, len(centre) + 1), lambda j:
           centre[j] + CASE WHEN j = b.i THEN side * sqrt(b.scatter / b.n) ELSE 0 END) ELSE centre END
  FROM m{t} m, (
    SELECT c, i, scatter, n FROM w{t} JOIN (
      SELECT c FROM w{t} WHERE k = {t + 1} GROUP BY c ORDER BY sum(scatter) DESC, c LIMIT 1) widest USING (c)
    WHERE k = {t + 1} ORDER BY scatter DESC, i LIMIT 1) b, (VALUES (-1), (1)) z(side)
  WHERE m.k = {t + 1} AND (m.c = b.c OR side = -1)""" if grow else "") + """
)""")
    return ",".join(parts)


_SPLIT_SQL = _split_sql(SPLIT_K, SPLIT_ROUNDS)
_LAST = SPLIT_K - 1 + SPLIT_ROUNDS


@query(
    f"""
WITH {_SPLIT_SQL},
z AS MATERIALIZED (
  SELECT k, c, n, list(m ORDER BY i) AS mean, sum(scatter) AS scatter FROM w{_LAST} GROUP BY k, c, n
),
away AS (
  SELECT a.vec_id, a.k, a.c, a.d, z.c AS other, z.n,
         (list_distance(a.v, z.mean) ** 2 + z.scatter / z.n)
         * CASE WHEN z.c = a.c THEN z.n / greatest(z.n - 1, 1) ELSE 1 END AS far
  FROM a{_LAST} a JOIN z USING (k)
),
s AS (
  SELECT vec_id, k, any_value(d) AS d, max(CASE WHEN c = other THEN far END) AS a,
         max(CASE WHEN c = other THEN n END) AS n, min(CASE WHEN c <> other THEN far END) AS b
  FROM away GROUP BY vec_id, k
)
SELECT k::INT AS k, (SELECT count(*) FROM z WHERE z.k = s.k)::INT AS filled, round(sum(d), 5) AS inertia,
       CASE WHEN k > 1 THEN round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
       END AS silhouette
FROM s GROUP BY k
"""
)
def split_sweep(spark, d):
    """Inertia and silhouette of k-means for every cluster count up to ten, from shared passes."""
    scores = X.split_sets(vectors(spark, d), "vector", SPLIT_K, SPLIT_ROUNDS).scores(spark)
    return scores.select(
        "k", "filled", F.round("inertia", 5).alias("inertia"),
        F.when(~F.isnan("silhouette"), F.round("silhouette", 6)).alias("silhouette"),
    )


@query(f"WITH {_SPLIT_SQL} SELECT vec_id, k::INT AS k, c::INT AS cluster FROM a{_LAST}")
def split_labels(spark, d):
    """The cluster of every row for every cluster count up to ten."""
    rows = vectors(spark, d)
    sets = X.split_sets(rows, "vector", SPLIT_K, SPLIT_ROUNDS).centres
    if not sets:
        return rows.select("vec_id", F.lit(0).alias("k"), F.lit(0).alias("cluster")).limit(0)
    names = [f"c{k + 1}" for k in range(len(sets))]
    labelled = X.with_split_labels(rows.select("vec_id", "vector"), "vector", sets, names)
    entries = F.array(*[F.struct(F.lit(k + 1).alias("k"), F.col(n).alias("cluster")) for k, n in enumerate(names)])
    return labelled.select("vec_id", F.inline(entries))


# --- representatives ---------------------------------------------------------

_SIMILAR = (
    Q.COORDS
    + """,
centroid AS (SELECT cluster, i, avg(x) AS m FROM coords GROUP BY cluster, i),
nearness AS (
  SELECT vec_id, cluster, sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))) AS similarity
  FROM coords JOIN centroid USING (cluster, i) GROUP BY vec_id, cluster
)
"""
)


@query("WITH" + _SIMILAR + "SELECT cluster, i::INT - 1 AS i, round(m, 6) AS m FROM centroid")
def centroids(spark, d):
    means = R.centroids(vectors(spark, d), "cluster", "vector")
    return means.select("cluster", F.posexplode("centroid").alias("i", "m")).withColumn("m", F.round("m", 6))


@query("WITH" + _SIMILAR + "SELECT vec_id, cluster, round(similarity, 6) AS similarity FROM nearness")
def centroid_cosine(spark, d):
    scored = R.similarity_to_centroid(vectors(spark, d), "cluster", "vector", "vec_id")
    return scored.select("vec_id", "cluster", F.round("similarity", 6).alias("similarity"))


_RANKED = (
    _SIMILAR
    + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY similarity DESC, vec_id) AS rank
  FROM nearness WHERE cluster NOT IN (0, 4)
)
"""
)


@query("WITH" + _RANKED + "SELECT cluster, rank::INT AS rank, vec_id, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 20")
def representatives(spark, d):
    top = R.representatives(vectors(spark, d), "cluster", "vector", "vec_id", 20, K.UNREPRESENTED_CLUSTERS)
    return top.select("cluster", "rank", "vec_id", F.round("similarity", 6).alias("similarity"))


#: Labels of the given tables, for the SQL; the query takes them from the data.
_SHOWN = [c for c in range(10) if c not in K.UNREPRESENTED_CLUSTERS]


@query(
    "WITH"
    + _RANKED
    + "SELECT rank::INT AS rank, "
    + ", ".join(f"max(CASE WHEN cluster = {c} THEN md5(text) END) AS cluster_{c}" for c in _SHOWN)
    + " FROM ranked JOIN documents ON doc_id = vec_id WHERE rank <= 20 GROUP BY rank"
)
def representative_texts(spark, d):
    """Rank by cluster table of the texts nearest to the cluster means."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), F.md5("text").alias("text"))
    return R.representative_texts(vectors(spark, d), texts, "cluster", "vector", "vec_id", "text", excluded=K.UNREPRESENTED_CLUSTERS)


@query(
    "WITH"
    + _SIMILAR
    + """
SELECT a.cluster AS cluster_a, b.cluster AS cluster_b,
       round(sum(a.m * b.m) / (sqrt(sum(a.m * a.m)) * sqrt(sum(b.m * b.m))), 6) AS similarity
FROM centroid a JOIN centroid b USING (i) GROUP BY a.cluster, b.cluster
"""
)
def centroid_similarity(spark, d):
    pairs = R.centroid_similarity(vectors(spark, d), "cluster", "vector")
    return pairs.withColumn("similarity", F.round("similarity", 6))


_NAME_ROWS = ", ".join(f"({k}, '{v}')" for k, v in K.CLUSTER_NAMES.items())


@query(
    f"""
SELECT label AS cluster, name, count(*) AS n
FROM embeddings LEFT JOIN (VALUES {_NAME_ROWS}) AS t(cluster, name) ON t.cluster = label GROUP BY ALL
"""
)
def cluster_names(spark, d):
    names = spark.createDataFrame(list(K.CLUSTER_NAMES.items()), "cluster int, name string")
    named = R.named_clusters(vectors(spark, d).select("vec_id", "cluster"), names)
    return named.groupBy("cluster", "name").agg(F.count(F.lit(1)).alias("n"))


# --- patterns ----------------------------------------------------------------

SUPPORT, CONFIDENCE = 0.01, 0.1

_CLOSED = (
    Q.LABELLED
    + f""",
baskets AS (
  SELECT e.label AS cluster, d.doc_id, coalesce(items, []) AS items
  FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id
  LEFT JOIN (SELECT doc_id, list(DISTINCT word) AS items FROM labelled GROUP BY doc_id) USING (doc_id)
),
numbers AS (SELECT cluster, count(*) AS n, greatest(1, ceil(round({SUPPORT} * count(*), 9))) AS need FROM baskets GROUP BY cluster),
"""
    + """
frequent AS (
  SELECT cluster, item, docs FROM (
    SELECT cluster, item, list_sort(list(doc_id)) AS docs
    FROM (SELECT cluster, doc_id, unnest(items) AS item FROM baskets) GROUP BY cluster, item)
  JOIN numbers USING (cluster) WHERE len(docs) >= need
),
reached AS (
  SELECT cluster, docs FROM frequent
  UNION
  SELECT cluster, docs FROM (
    SELECT r.cluster, list_sort(list_intersect(r.docs, f.docs)) AS docs, z.need
    FROM reached r JOIN frequent f USING (cluster) JOIN numbers z USING (cluster))
  WHERE len(docs) >= need
),
sets AS (
  SELECT r.cluster, r.docs, list_sort(list(f.item)) AS items, len(r.docs)::BIGINT AS freq
  FROM reached r JOIN frequent f ON f.cluster = r.cluster AND list_has_all(f.docs, r.docs) GROUP BY r.cluster, r.docs
),
rules AS (
  SELECT s.cluster, s.items AS antecedent, s.docs AS holders, f.item AS consequent,
         len(list_intersect(s.docs, f.docs)) / s.freq AS confidence,
         (len(list_intersect(s.docs, f.docs)) / s.freq) / (len(f.docs) / z.n) AS lift,
         len(list_intersect(s.docs, f.docs)) / z.n AS support
  FROM sets s JOIN frequent f USING (cluster) JOIN numbers z USING (cluster)
  WHERE NOT list_contains(s.items, f.item) AND len(list_intersect(s.docs, f.docs)) >= z.need
    AND len(list_intersect(s.docs, f.docs)) / s.freq >= """
    + f"{CONFIDENCE}"
    + """
)
"""
)


def _closed(spark, d):
    """Closed sets of the keywords of a speech: fewer than a hundred words, so a basket is bounded."""
    baskets = stored(labelled_keywords(spark, d), "baskets")
    return S.closed_sets(baskets, "cluster", "doc_id", "keywords", SUPPORT)


@query("WITH RECURSIVE" + _CLOSED + "SELECT cluster, array_to_string(items, ' ') AS items, len(items)::INT AS size, freq FROM sets")
def frequent_sets(spark, d):
    """Closed sets, which give the frequency of all others."""
    sets = S.frequent_closed_sets(_closed(spark, d)).withColumn("items", F.array_join("items", " "))
    return sets.orderBy(F.desc("freq"), "cluster", "items")


@query(
    "WITH RECURSIVE"
    + _CLOSED
    + """
SELECT cluster, array_to_string(antecedent, ' ') AS antecedent, consequent, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift, round(support, 6) AS support
FROM rules
"""
)
def association_rules(spark, d):
    return S.closed_rules(_closed(spark, d), CONFIDENCE).select(
        "cluster",
        F.array_join("antecedent", " ").alias("antecedent"),
        F.array_join("consequent", " ").alias("consequent"),
        *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")],
    ).orderBy(F.desc("confidence"), "cluster", "antecedent", "consequent")


@query(
    "WITH RECURSIVE"
    + _CLOSED
    + """
SELECT b.cluster, b.doc_id, coalesce(prediction, '') AS prediction
FROM baskets b LEFT JOIN (
  SELECT doc_id, string_agg(DISTINCT consequent, ' ' ORDER BY consequent) AS prediction
  FROM (SELECT cluster, unnest(holders) AS doc_id, consequent FROM rules) r JOIN baskets b USING (cluster, doc_id)
  WHERE NOT list_contains(b.items, r.consequent) GROUP BY doc_id
) USING (doc_id)
"""
)
def predicted_items(spark, d):
    predicted = S.predicted_words(_closed(spark, d), "doc_id", CONFIDENCE)
    return predicted.select("cluster", "doc_id", F.array_join("prediction", " ").alias("prediction"))
