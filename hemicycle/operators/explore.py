"""Joins, filters, group statistics, rankings and samples of the analysis table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import scale


# --- joins and filters -------------------------------------------------------


def full_table(clusters: DataFrame, interventions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clusters, interventions and session info joined into the analysis table."""
    joined = clusters.join(interventions, "intervention_id")
    return joined.join(sessions, "session_id")


def with_measures(df: DataFrame, words: str = "intervention_words", date: str = "date") -> DataFrame:
    """Add the number of words (unless counted before) and the year."""
    day = F.to_date(date)
    added = {date: day, "year": F.year(day)}
    if "num_words" not in df.columns:
        added["num_words"] = F.size(words)
    return df.withColumns(added)


def keep_clusters(df: DataFrame, labels: Sequence[int], cluster: str = "cluster") -> DataFrame:
    return df.filter(F.col(cluster).isin(*labels))


def drop_clusters(df: DataFrame, labels: Sequence[int], cluster: str = "cluster") -> DataFrame:
    return df.filter(~F.col(cluster).isin(*labels))


def split_at(df: DataFrame, col: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cutoff, and rows after it."""
    return df.filter(F.col(col) <= cutoff), df.filter(F.col(col) > cutoff)


def not_landed(listing: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Listed documents that are not stored yet."""
    return listing.join(landed.select(key), key, "left_anti")


# --- counts and pivots -------------------------------------------------------


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key, largest first, ties by key."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), *keys)


def count_pivot(
    df: DataFrame, row: str, cluster: str, labels: Sequence[int] | None = None, prefix: str = "cluster_"
) -> DataFrame:
    """Rows per value of ``row`` with one count column per label, zero where empty.

    Counts are conditional sums over one partial aggregation, so the labels cost
    no extra pass. Without ``labels`` all that occur get a column; a given list leaves
    rows of other labels out.
    """
    labels = labels_of(df, cluster) if labels is None else labels
    kept = keep_clusters(df, labels, cluster)
    per_label = [F.count_if(F.col(cluster) == label).alias(f"{prefix}{label}") for label in labels]
    return kept.groupBy(row).agg(*per_label)


def labels_of(df: DataFrame, cluster: str = "cluster") -> list:
    """Distinct labels, ascending; labels name a handful of clusters."""
    return [r[0] for r in df.select(cluster).distinct().orderBy(cluster).collect()]


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


# --- distribution ------------------------------------------------------------

QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, per group or overall.

    The source is read once, to count its values; all figures come from the counts.
    """
    key = group or "_all"
    values = df if group else df.withColumn(key, F.lit(0))
    counts = scale.value_counts(values, value, [key])
    x, c = F.col(value), F.col("_c")
    totals = counts.groupBy(key).agg(
        F.sum(c).alias("count"),
        (F.sum(x * c) / F.sum(c)).alias("mean"),
        F.min(x).cast("double").alias("min"),
        F.max(x).cast("double").alias("max"),
    )
    quartiles = scale.exact_quantiles(counts, value, QUARTILES, [key])
    summary = totals.join(quartiles, key)
    centred = counts.join(totals.select(key, "mean", "count"), key)
    deviation = F.try_divide(F.sum((x - F.col("mean")) * (x - F.col("mean")) * c), F.first("count") - 1)
    spread = centred.groupBy(key).agg(F.sqrt(deviation).alias("std"))
    return summary.join(spread, key).select(
        *([group] if group else []), "count", "mean", "std", "min",
        F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max",
    )


def histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """``(bin, low, high, count)`` for equal-width bins from 1; the maximum lands in the last.

    The source is read once, to count its values.
    """
    x = F.col(value).cast("double")
    counts = scale.value_counts(df.select(x.alias("_x")), "_x", [])
    low, high = (F.lit(v).cast("double") for v in counts.agg(F.min("_x"), F.max("_x")).first())
    placed = F.when(high > low, F.least(F.width_bucket("_x", low, high, F.lit(bins)), F.lit(bins)))
    binned = (
        counts.select(F.coalesce(placed, F.lit(1)).cast("int").alias("bin"), "_c")
        .groupBy("bin")
        .agg(F.sum("_c").alias("count"))
    )
    width = (high - low) / bins
    start = low + (F.col("bin") - 1) * width
    return binned.select("bin", start.alias("low"), (start + width).alias("high"), "count")


# --- rankings ----------------------------------------------------------------


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group; cut to ``n`` per partition before the shuffle."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def top_words(df: DataFrame, cluster: str, words: str, n: int = 20) -> DataFrame:
    """Most frequent words per cluster, repetitions counted, ties by word."""
    counts = (
        df.select(cluster, F.explode(words).alias("word"))
        .groupBy(cluster, "word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return top_per_group(counts, cluster, [F.desc("count"), F.asc("word")], n)


def wide_by_rank(df: DataFrame, rank: str, cluster: str, value: str, labels: Sequence[int]) -> DataFrame:
    """One column of values per cluster; a short cluster is filled with nulls."""
    picked = [
        F.max(F.when(F.col(cluster) == label, F.col(value))).alias(f"cluster_{label}") for label in labels
    ]
    return df.groupBy(rank).agg(*picked)


# --- samples -----------------------------------------------------------------


def draw_key(seed: int, row_id: str) -> Column:
    """Pseudo-random key of a row that any run reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def sample_n(df: DataFrame, cluster: str, row_id: str, n: int = 5, seed: int = 42) -> DataFrame:
    """``n`` random rows per cluster."""
    return top_per_group(df, cluster, [draw_key(seed, row_id), F.col(row_id)], n)


def sample_fraction(
    df: DataFrame, cluster: str, row_id: str, fraction: float = 0.05, seed: int = 42
) -> DataFrame:
    """Exactly ``round(fraction * rows)`` random rows per cluster, halves to the even number.

    Rows are numbered by draw key within key buckets, so a large cluster is spread
    over the buckets.
    """
    keyed = df.withColumn("_draw", draw_key(seed, row_id))
    head = F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int")
    numbered = scale.number_rows(keyed, [cluster], F.struct("_draw", row_id), head, "_nth")
    quota = df.groupBy(cluster).agg(F.bround(F.count(F.lit(1)) * fraction).alias("_quota"))
    return (
        numbered.join(quota, cluster)
        .filter(F.col("_nth") <= F.col("_quota"))
        .drop("_draw", "_nth", "_quota")
    )


def ids_by_cluster(sample: DataFrame, cluster: str, row_id: str) -> DataFrame:
    """Cluster to sorted list of sampled ids; the sample bounds the list."""
    return sample.groupBy(cluster).agg(F.sort_array(F.collect_list(row_id)).alias("ids"))


def sample_texts(
    sample: DataFrame, interventions: DataFrame, row_id: str, text: str, length: int = 100
) -> DataFrame:
    """Text previews of sampled rows by one join."""
    previews = interventions.select(row_id, F.substring(text, 1, length).alias("preview"))
    return sample.join(previews, row_id)


def running_share(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Cumulative sum in order, for frames with one row per component."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(upto))
