"""Clustering, scores and parameter sweeps."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from . import features as L
from ..functions.vectors import to_vector
from ..session import side_by_side, stored
from .explore import drop_clusters

ALGORITHMS = {"kmeans": KMeans, "gmm": GaussianMixture}


def estimator(algorithm: str, k: int, features: str = "features", seed: int = 0, cluster: str = "cluster"):
    options = dict(k=k, featuresCol=features, predictionCol=cluster, seed=seed)
    if algorithm == "gmm":
        options["probabilityCol"] = "_probability"
    return ALGORITHMS[algorithm](**options)


def fit_clusters(
    df: DataFrame, algorithm: str, k: int, features: str = "features", seed: int = 0, cluster: str = "cluster"
) -> DataFrame:
    """The input with a cluster label per row."""
    model = estimator(algorithm, k, features, seed, cluster).fit(df)
    return model.transform(df).drop("_probability")


def silhouette(
    labelled: DataFrame, features: str = "features", cluster: str = "cluster", measure: str = "squaredEuclidean"
) -> float:
    """Mean silhouette from cluster sums; ``measure`` is squaredEuclidean or cosine."""
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette", distanceMeasure=measure
    )
    return evaluator.evaluate(labelled)


def fit_and_score(
    df: DataFrame, algorithm: str, k: int, features: str = "features", seed: int = 0
) -> tuple[DataFrame, dict]:
    """Labelled frame plus the algorithm, cluster count and score."""
    labelled = fit_clusters(df, algorithm, k, features, seed)
    found = labelled.select("cluster").distinct().count()
    score = silhouette(labelled, features) if found > 1 else float("nan")
    return labelled, {"algorithm": algorithm, "features": features, "k": k, "silhouette": score}


def sweep(
    df: DataFrame,
    feature_cols: Sequence[str],
    ks: Sequence[int],
    algorithms: Sequence[str] = ("kmeans", "gmm"),
    seed: int = 0,
) -> DataFrame:
    """Score of every algorithm, feature column and cluster count, best first."""
    kept = df.select(*feature_cols).persist(StorageLevel.MEMORY_AND_DISK)
    runs = [(a, k, f) for f in feature_cols for a in algorithms for k in ks]
    try:
        rows = side_by_side([lambda r=r: fit_and_score(kept, *r, seed)[1] for r in runs])
    finally:
        kept.unpersist()
    table = df.sparkSession.createDataFrame(
        [(r["algorithm"], r["features"], r["k"], r["silhouette"]) for r in rows],
        "algorithm string, features string, k int, silhouette double",
    )
    return table.orderBy(F.desc("silhouette"), "algorithm", "features", "k")


def reduce_and_label(
    df: DataFrame,
    vector: str,
    k: int,
    components: int | None = None,
    share: float = 0.9,
    algorithm: str = "kmeans",
    seed: int = 0,
) -> DataFrame:
    """Label rows by their SVD scores; without ``components`` enough are kept for ``share``."""
    if components is None:
        gram = L.gram_matrix(df, vector)
        n, sums = gram[-1, -1], gram[-1, :-1]
        values = np.linalg.eigvalsh(gram[:-1, :-1] - np.outer(sums, sums) / n)[::-1]
        components = L.components_for(list(values / values.sum()), share)
    svd = L.fit_svd(df, vector, components)
    scored = L.svd_scores(df, vector, svd, out="_svd").withColumn("_features", to_vector(F.col("_svd")))
    return fit_clusters(scored, algorithm, k, "_features", seed).drop("_svd", "_features")


def two_rounds(
    df: DataFrame, vector: str, noise: int, first_k: int = 4, second_k: int = 5, seed: int = 0
) -> DataFrame:
    """Label, drop the noise cluster, reduce again on what is left and relabel.

    The first labels are stored, so that no stage runs the Python workers of both rounds.
    """
    first = stored(reduce_and_label(df, vector, first_k, seed=seed), "first-labels")
    kept = drop_clusters(first, [noise]).withColumnRenamed("cluster", "first_cluster")
    return reduce_and_label(kept, vector, second_k, seed=seed)


def silhouette_euclidean(
    labelled: DataFrame, vector: str, row_id: str, cluster: str = "cluster", block_rows: int = 10_000
) -> DataFrame:
    """``(row_id, cluster, silhouette)`` under plain Euclidean distance, exact.

    The measure needs every distance, so its cost is quadratic in rows; prefer
    :func:`silhouette` for large tables. Rows are hashed into blocks, each task
    meets two blocks and emits one distance sum per row and cluster. No pair of
    rows is emitted and no task holds more than two blocks.
    """
    rows = labelled.select(
        F.col(row_id).alias("id"), F.col(cluster).alias("c"), F.col(vector).cast("array<double>").alias("x")
    ).filter(F.col("c").isNotNull() & F.col("x").isNotNull())
    blocks = max(1, -(-rows.count() // block_rows))
    own_block, any_block = F.pmod(F.xxhash64("id"), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.withColumn("i", own_block.cast("int")).withColumn("j", any_block)
    right = rows.select("id", "c", "x", own_block.cast("int").alias("j")).withColumn("i", any_block)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    sums = (
        left.groupBy("i", "j")
        .cogroup(right.groupBy("i", "j"))
        .applyInPandas(_distance_sums, f"id {types['id']}, c {types['c']}, other {types['c']}, total double")
        .groupBy("id", "c", "other")
        .agg(F.sum("total").alias("total"))
    )
    sizes = rows.groupBy(F.col("c").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    own = F.col("c") == F.col("other")
    scored = (
        sums.join(sizes, "other")
        .groupBy("id", "c")
        .agg(
            F.max(F.when(own, F.col("n"))).alias("n"),
            F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
        )
    )
    value = F.when(F.greatest("a", "b") > 0, (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    alone = F.col("n") == 1
    return scored.select(
        F.col("id").alias(row_id),
        F.col("c").alias(cluster),
        F.when(alone, 0.0).otherwise(F.coalesce(value, F.lit(0.0))).alias("silhouette"),
    )


def _distance_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Distances of the left rows to the right rows, added up per right cluster."""
    tile = 512
    if left.empty or right.empty:
        return pd.DataFrame({"id": [], "c": [], "other": [], "total": []})
    groups = {c: np.stack(part["x"].to_numpy()) for c, part in right.groupby("c")}
    out = []
    for start in range(0, len(left), tile):
        part = left.iloc[start : start + tile]
        x = np.stack(part["x"].to_numpy())
        for c, y in groups.items():
            squared = (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2.0 * x @ y.T
            total = np.sqrt(np.where(squared < 1e-12, 0.0, squared)).sum(axis=1)
            out.append(pd.DataFrame({"id": part["id"], "c": part["c"], "other": c, "total": total}))
    return pd.concat(out, ignore_index=True)
