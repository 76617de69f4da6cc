"""Cluster centres and the speeches closest to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine, to_vector
from .explore import drop_clusters, labels_of, top_per_group, wide_by_rank


def centroids(df: DataFrame, cluster: str, vector: str, out: str = "centroid") -> DataFrame:
    """Mean vector per cluster."""
    mean = Summarizer.mean(to_vector(F.col(vector)))
    return df.groupBy(cluster).agg(vector_to_array(mean).alias(out))


def similarity_to_centroid(df: DataFrame, cluster: str, vector: str, row_id: str) -> DataFrame:
    """Add the cosine similarity of each row to the mean of its cluster."""
    joined = df.join(centroids(df, cluster, vector), cluster)
    scored = cosine(F.col(vector).cast("array<double>"), F.col("centroid"))
    return joined.withColumn("similarity", scored).drop("centroid")


def representatives(
    df: DataFrame,
    cluster: str,
    vector: str,
    row_id: str,
    n: int = 20,
    excluded: Sequence[int] = (),
) -> DataFrame:
    """The ``n`` rows of each cluster most similar to its mean, ties by id."""
    kept = drop_clusters(df, excluded, cluster) if excluded else df
    scored = similarity_to_centroid(kept, cluster, vector, row_id)
    return top_per_group(scored, cluster, [F.desc("similarity"), F.asc(row_id)], n)


def representative_texts(
    df: DataFrame,
    texts: DataFrame,
    cluster: str,
    vector: str,
    row_id: str,
    text: str,
    labels: Sequence[int] | None = None,
    n: int = 20,
    excluded: Sequence[int] = (),
) -> DataFrame:
    """Rank by cluster table of representative texts; texts are joined after the cut.

    Without ``labels`` every label that occurs gets a column, but for the ``excluded`` ones.
    """
    if labels is None:
        labels = [c for c in labels_of(df, cluster) if c is not None and c not in excluded]
    picked = representatives(df.filter(F.col(cluster).isin(*labels)), cluster, vector, row_id, n)
    with_text = picked.select(row_id, cluster, "rank").join(texts.select(row_id, text), row_id)
    return wide_by_rank(with_text, "rank", cluster, text, labels)


def centroid_similarity(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(cluster_a, cluster_b, similarity)`` for all ordered pairs of cluster means.

    The means are normalised and turned into one row per coordinate; the products
    are summed per pair of clusters, joined on the coordinate.
    """
    means = centroids(df, cluster, vector)
    coords = means.select(
        cluster, F.posexplode("centroid").alias("_i", "_x")
    )
    a = coords.select(F.col(cluster).alias("cluster_a"), "_i", F.col("_x").alias("_a"))
    b = coords.select(F.col(cluster).alias("cluster_b"), "_i", F.col("_x").alias("_b"))
    size = F.sqrt(F.sum(F.col("_a") * F.col("_a"))) * F.sqrt(F.sum(F.col("_b") * F.col("_b")))
    return (
        a.join(b, "_i")
        .groupBy("cluster_a", "cluster_b")
        .agg(F.sum(F.col("_a") * F.col("_b")).alias("_dot"), size.alias("_size"))
        .select(
            "cluster_a",
            "cluster_b",
            F.when(F.col("_size") > 0, F.col("_dot") / F.col("_size")).otherwise(0.0).alias("similarity"),
        )
    )


def named_clusters(df: DataFrame, names: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Add the display name of each cluster; unnamed clusters get null."""
    return df.join(names, cluster, "left")
