"""Row-local token expressions: no shuffle, no Python worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K
from .text import strip

WORD = r"[\p{L}\p{N}]+"
TERM = r"[\p{L}\p{N}_]{2,}"
_SENTENCE_END = r"(?<=[.!?…])[ \t\n\r\f]+"


def basket_pipeline(
    text_col: str, stop_words: Sequence[str] = K.STOP_WORDS, out: str = "filtered_tokens"
) -> Pipeline:
    """Lower-case, split on each white-space character, drop stop words."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol=text_col, outputCol="tokens"),
            StopWordsRemover(inputCol="tokens", outputCol=out, stopWords=list(stop_words)),
        ]
    )


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Drop listed words; repetitions of the others stay."""
    return F.filter(tokens, lambda t: ~t.isin(*words))


def valid_words(tokens: Column) -> Column:
    """Keep letter-only tokens; null becomes an empty array."""
    kept = F.filter(tokens, lambda t: t.rlike(K.VALID_WORD_PATTERN))
    return F.coalesce(kept, F.array().cast("array<string>"))


def distinct_in_order(tokens: Column) -> Column:
    return F.array_distinct(tokens)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body repeats it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_tokens(text: Column) -> Column:
    """Words and numbers in order, case kept, punctuation dropped."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def terms(text: Column) -> Column:
    """Lower-case terms of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def term_counts(text: Column) -> Column:
    """``array<struct<term, tf>>``: distinct terms of a text, ascending, with their counts.

    The sorted terms are cut into runs, so a text is counted where it is read and
    needs no shuffle of its tokens.
    """

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(
            places, lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2))
        )
        return let(starts, lambda begin: F.transform(begin, lambda i, k: entry(ordered, begin, n, i, k)))

    def entry(ordered: Column, begin: Column, n: Column, i: Column, k: Column) -> Column:
        end = F.coalesce(F.get(begin, k + 1), n + 1)
        return F.struct(F.get(ordered, i - 1).alias("term"), (end - i).alias("tf"))

    return let(F.sort_array(terms(text)), runs)


def looks_like_number(token: Column, lang: str = "es") -> Column:
    return token.rlike(r"^\p{N}+$") | token.isin(*K.NUMBER_WORDS[lang])


def content_tokens(
    text: Column, stop_words: Sequence[str], extra_stop: Sequence[str] = (), lang: str = "es"
) -> Column:
    """Lower-case surface forms without stop words, punctuation and numbers."""
    drop = [*stop_words, *extra_stop]
    return F.filter(
        word_tokens(F.lower(text)), lambda t: ~t.isin(*drop) & ~looks_like_number(t, lang)
    )


def sentences(text: Column) -> Column:
    """Sentence texts, trimmed, blanks dropped."""
    parts = F.transform(F.split(text, _SENTENCE_END), strip)
    return F.filter(parts, lambda s: F.length(s) > 0)


def baskets(df: DataFrame, text_col: str, stop_words: Sequence[str] = K.STOP_WORDS) -> DataFrame:
    """Add ``items``: the distinct valid non-stop tokens of a speech, first occurrence first."""
    tokenised = basket_pipeline(text_col, stop_words).fit(df).transform(df)
    return tokenised.withColumn(
        "items", distinct_in_order(valid_words(F.col("filtered_tokens")))
    ).drop("tokens", "filtered_tokens")
