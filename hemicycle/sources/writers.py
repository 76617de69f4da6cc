"""Table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Overwrite a Parquet table; the row count is observed during the write."""
    return _counted(df, lambda d: d.write.mode("overwrite").partitionBy(*partition_by).parquet(path))


def write_csv(df: DataFrame, path: str) -> int:
    """Overwrite a CSV folder with a header; flat columns only. Returns the row count."""
    return _counted(
        df,
        lambda d: d.write.mode("overwrite").options(header=True, escape='"', emptyValue='""').csv(path),
    )


def _counted(df: DataFrame, write) -> int:
    seen = Observation("rows")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]
