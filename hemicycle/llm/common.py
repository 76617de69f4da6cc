"""Column expressions and small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_of(column: str) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", "")


def words_of(text: Column) -> Column:
    """Words between separators, in order."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_rows(docs: DataFrame, **columns: Column) -> DataFrame:
    """The named columns next to ``row``, a struct of the input row.

    Operators that hand on their input work on this form, so input columns may have any
    name; ``select("row.*")`` gives the input's columns back.
    """
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       *[c.alias(n) for n, c in columns.items()])


def token_hash(seed: object, *columns: Column) -> Column:
    """60 bits of an md5 over the seed and the columns; null reads as an empty string.

    The same number on any engine with md5, under any partitioning.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
