"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``; ``root`` is the smallest node reachable.

    Large-star and small-star steps by turns: each links the neighbours of a node to the
    smallest of them, first the larger neighbours, then the others. Nothing but a count and
    a checksum reaches the driver, and every round is written to the shared folder, so
    lineage stays short and a lost executor costs one step. Null nodes are left out; loops
    and repeated edges change nothing; no edges give no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stored(links, "links")
    state = None
    while True:
        new = _mark(links)
        if new == state:
            break
        state = new
        if not new[0]:
            break
        links = stored(_small_star(_large_star(links)), "links")
    # Every remaining link is from a node to its root; roots have none themselves.
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _mark(links: DataFrame) -> tuple[int, object]:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour larger than a node moves to the smallest neighbour."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("least")
    )
    moved = both.where("b > a").join(least, F.col("a") == F.col("node"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "node")
    joined = links.join(least, F.col("a") == F.col("node"))
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()
