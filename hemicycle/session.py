"""Session construction and shared scratch storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Has the shuffle files of a query removed as soon as it ends; otherwise they stay until the driver collects garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Settings a submitting script would normally pass; all can be overridden.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "hemicycle", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting it is a folder below ``spark.sql.warehouse.dir``, which every
    executor has to reach anyway.
    """
    configured = (
        spark.conf.get(CHECKPOINT_KEY, None)
        or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
        or spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def side_by_side(actions: Sequence[Callable[[], T]], threads: int = 4) -> list[T]:
    """Results of independent Spark actions, a few submitted at a time."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(inherit(a)) for a in actions]]


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For results that several later steps read: they are computed once, and a lost
    executor costs no more than the step at hand. Shuffle files of the write go when it ends.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)
