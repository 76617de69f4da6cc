"""Table and document readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas


def read_session_csv(
    spark: SparkSession, path: str, schema: StructType | str = schemas.SESSION_TEXT, max_chars: int = -1
) -> DataFrame:
    """Session file with a fixed schema; quoted values may span lines.

    Such a file is one task however long it is: convert it to Parquet once. ``max_chars``
    limits a value; -1 does not.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, escape='"', multiLine=True, maxCharsPerColumn=max_chars)
        .csv(path)
    )


def read_text_csv(spark: SparkSession, path: str, index_col: bool = False, max_chars: int = -1) -> DataFrame:
    """CSV with a header and every column text; optionally without its index column."""
    df = spark.read.options(
        header=True, escape='"', multiLine=True, inferSchema=False, maxCharsPerColumn=max_chars
    ).csv(path)
    return df.drop(df.columns[0]) if index_col else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def file_id(name: Column, suffix_length: int = 4) -> Column:
    """Document id: the file name without its suffix."""
    return F.substr(name, F.lit(1), F.length(name) - suffix_length)


def read_documents(spark: SparkSession, path: str, suffix_length: int = 4) -> DataFrame:
    """``(doc, raw_text)`` for a folder of text documents, one row per file."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(file_id(F.col("_metadata.file_name"), suffix_length).alias("doc"), F.col("value").alias("raw_text"))


def list_documents(spark: SparkSession, path: str, suffix_length: int = 4) -> DataFrame:
    """``(doc, bytes)`` for a folder of files; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        file_id(F.element_at(F.split("path", "/"), -1), suffix_length).alias("doc"), F.col("length").alias("bytes")
    )


def split_rejects(df: DataFrame, problems: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every check, and the others with the names of the checks they fail.

    A check is a condition that holds for a bad row. Bad rows never stop a run.
    """
    failed = F.array_compact(
        F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in problems.items()])
    )
    checked = df.withColumn("problems", failed)
    ok = checked.filter(F.size("problems") == 0).drop("problems")
    return ok, checked.filter(F.size("problems") > 0)
