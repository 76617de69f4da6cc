"""Sessions to one row per intervention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.literals import split_nested_list


def explode_interventions(
    sessions: DataFrame,
    interventions: str = "interventions",
    session: str = "id",
    stable_id: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(session, int_id, intervention)`` and the columns in ``keep`` from an array column.

    The stable id is a 128-bit digest of session and position, so it does not change with
    the partitioning; otherwise ids are unique and increasing within a partition.
    """
    exploded = sessions.select(
        F.col(session).alias("session"), F.posexplode(interventions).alias("_pos", "intervention"), *keep
    )
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("session").cast("string"), F.lit("")), F.col("_pos").cast("string")))
    int_id = digest if stable_id else F.monotonically_increasing_id()
    return exploded.select("session", int_id.alias("int_id"), "intervention", *keep)


def explode_legacy(sessions: DataFrame, stable_id: bool = True) -> DataFrame:
    """The same from a nested list literal kept as text."""
    parsed = sessions.withColumn("interventions", split_nested_list(F.col("interventions")))
    return explode_interventions(parsed, stable_id=stable_id)
