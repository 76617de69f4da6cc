"""Readers for list literals kept as text, and labels kept in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A quoted item of a list literal: either quote, with backslash escapes inside.
_QUOTED = r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)\""""


def strip_outer_brackets(text: Column) -> Column:
    return F.regexp_replace(text, r"^\[|\]$", "")


def split_nested_list(text: Column) -> Column:
    """Legacy reader of a nested list literal: one string per inner list.

    The outermost pair of brackets is removed once, so the first and the last
    element keep one bracket of their own.
    """
    return F.split(strip_outer_brackets(text), r"\], \[")


def parse_words(text: Column) -> Column:
    """List-of-strings literal to an array."""
    quoted = F.regexp_extract_all(text, F.lit(f"({_QUOTED})"), F.lit(1))
    return F.transform(
        quoted,
        lambda q: F.regexp_replace(F.substr(q, F.lit(2), F.length(q) - 2), r"\\(.)", "$1"),
    )


def parse_nested_words(text: Column) -> Column:
    """Nested list-of-strings literal to an array of arrays."""
    return F.transform(split_nested_list(text), parse_words)


def words_literal(words: Column) -> Column:
    """Array of strings to a list literal."""
    quoted = F.transform(
        words,
        lambda w: F.concat(F.lit("'"), F.regexp_replace(w, r"(['\\])", r"\\$1"), F.lit("'")),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def label_from_name(name: Column, part: int = 2) -> Column:
    """Integer label held between underscores of a file name."""
    return F.split_part(name, F.lit("_"), F.lit(part)).try_cast("int")
