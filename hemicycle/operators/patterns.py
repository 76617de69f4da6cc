"""Frequent word sets and rules, cluster by cluster."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import side_by_side, stored


def fit_patterns(
    baskets: DataFrame, items: str = "items", min_support: float = 0.01, min_confidence: float = 0.1
) -> FPGrowthModel:
    """FP-growth model of one set of baskets; items must be distinct within a basket."""
    return FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence).fit(baskets)


def _sorted_items(col: str) -> Column:
    return F.sort_array(col).alias(col)


def per_cluster(
    baskets: DataFrame,
    cluster: str,
    labels: Sequence,
    items: str = "items",
    min_support: float = 0.01,
    min_confidence: float = 0.1,
) -> dict[object, FPGrowthModel]:
    """One model per label. Each fit is a distributed job over the rows of its label."""

    def fit(label):
        own = baskets.filter(F.col(cluster) == label)
        return fit_patterns(own, items, min_support, min_confidence)

    models = side_by_side([partial(fit, label) for label in labels])
    return dict(zip(labels, models))


def frequent_sets(models: dict[object, FPGrowthModel], cluster: str = "cluster") -> DataFrame:
    """``(cluster, items, size, freq)``, items in alphabetical order."""
    parts = [
        m.freqItemsets.select(
            F.lit(label).alias(cluster), _sorted_items("items"), F.size("items").alias("size"), "freq"
        )
        for label, m in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def association_rules(models: dict[object, FPGrowthModel], cluster: str = "cluster") -> DataFrame:
    """``(cluster, antecedent, consequent, confidence, lift, support)``."""
    parts = [
        m.associationRules.select(
            F.lit(label).alias(cluster),
            _sorted_items("antecedent"),
            _sorted_items("consequent"),
            "confidence",
            "lift",
            "support",
        )
        for label, m in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def matched_rules(rules: DataFrame, baskets: DataFrame, cluster: str = "cluster", items: str = "items") -> DataFrame:
    """The baskets with ``prediction``: what the rules of their cluster suggest and they do not hold, in order.

    ``rules`` comes from :func:`association_rules`. A basket is first cut down to the words
    that its cluster's rules mention. A rule is looked up by the first word of its antecedent
    and holds if the basket has the others too. Baskets meet under a digest of their items,
    so equal ones are matched once. A null or empty basket gets an empty prediction.
    """
    digest = F.sha2(F.to_json(items), 256)
    held = baskets.select(cluster, digest.alias("basket"), items).distinct()
    held = held.select(cluster, "basket", F.explode(items).alias("item"))
    mentioned = rules.select(cluster, F.explode(F.concat("antecedent", "consequent")).alias("item")).distinct()
    known = held.join(mentioned, [cluster, "item"], "left_semi").groupBy(cluster, "basket")
    known = known.agg(F.collect_set("item").alias("known")).withColumn("first", F.explode("known"))
    listed = rules.select(
        cluster, F.array_min("antecedent").alias("first"), "antecedent", F.explode("consequent").alias("suggested")
    )
    holds = (F.size(F.array_except("antecedent", "known")) == 0) & ~F.array_contains("known", F.col("suggested"))
    found = known.join(listed, [cluster, "first"]).where(holds).groupBy(cluster, "basket")
    found = found.agg(F.sort_array(F.collect_set("suggested")).alias("prediction"))
    both = baskets.withColumn("basket", digest).join(found, [cluster, "basket"], "left")
    prediction = F.coalesce("prediction", F.array().cast(baskets.schema[items].dataType))
    return both.select(*[baskets[c] for c in baskets.columns], prediction.alias("prediction"))


def predicted_items(
    models: dict[object, FPGrowthModel], baskets: DataFrame, cluster: str = "cluster"
) -> DataFrame:
    """The baskets of the models' clusters with the consequents that the rules of their cluster suggest."""
    own = baskets.filter(F.col(cluster).isin(list(models)))
    return matched_rules(stored(association_rules(models, cluster), "rules"), own, cluster)
