"""Array-of-double expressions and vector literal parsing."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import let

FLOAT_PATTERN = r"(-?\d*\.\d+)"


def parse_vector(text: Column) -> Column:
    """Vector literal, comma or white-space separated; null when any entry is not a number."""
    body = F.trim(F.regexp_replace(F.regexp_replace(text, r"[\[\]]", ""), r"[,\s]+", " "))
    numbers = F.transform(F.split(body, " "), lambda x: x.try_cast("double"))
    return F.when(F.forall(numbers, lambda x: x.isNotNull()), numbers)


def parse_json_vector(text: Column) -> Column:
    """Strict list literal; null on any error."""
    return F.from_json(text, "array<double>")


def find_floats(text: Column) -> Column:
    """Every decimal number with a point found in the text."""
    found = F.regexp_extract_all(text, F.lit(FLOAT_PATTERN), F.lit(1))
    return F.transform(found, lambda x: x.cast("double"))


def to_vector(values: Column) -> Column:
    return array_to_vector(values.cast("array<double>"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, zero when either side is a zero vector."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def unit(a: Column) -> Column:
    """The vector scaled to length one; a zero vector stays zero."""

    def scaled(size: Column) -> Column:
        return F.transform(a, lambda x: F.when(size > 0, x / size).otherwise(F.lit(0.0)))

    return let(norm(a), scaled)
