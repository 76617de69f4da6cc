"""Token normalisation with a lemma table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import content_tokens, let
from ..session import stored


def normalize_tokens(
    df: DataFrame,
    doc: str,
    text: str,
    stop_words: Sequence[str],
    lemmas: DataFrame | None = None,
    extra_stop: Sequence[str] = (),
    lang: str = "es",
) -> DataFrame:
    """``(doc, tokens)``: content tokens in order, as lemmas when a table is given.

    ``text`` may be a string or an array of strings. ``lemmas`` holds ``(word,
    lemma)`` with one row per word; words it lacks keep their surface form.
    """
    joined = F.col(text)
    if df.schema[text].dataType.typeName() == "array":
        joined = F.array_join(joined, " ")
    tokens = content_tokens(joined, stop_words, extra_stop, lang)
    if lemmas is None:
        return df.select(doc, tokens.alias("tokens"))
    return as_lemmas(stored(df.select(doc, tokens.alias("tokens")), "content-tokens"), doc, lemmas)


def as_lemmas(surface: DataFrame, doc: str, lemmas: DataFrame) -> DataFrame:
    """``(doc, tokens)`` with the lemma of every token that has one; one row per row of ``surface``.

    Only tokens with a lemma are brought back to their row, which keeps its array. ``surface`` is
    read twice, so pass a stored table. Rows equal in id and hash of their tokens have equal tokens.
    """
    known = surface.select(doc, F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    rows = known.withColumn("_hash", F.xxhash64("tokens"))
    words = rows.select(doc, "_hash", F.posexplode("tokens").alias("_pos", "word"))
    found = words.join(lemmas.select("word", "lemma").where("lemma <> word"), "word")
    entry = F.struct("_pos", F.lit(1).alias("_new"), F.col("lemma").alias("token"))
    found = found.groupBy(F.col(doc).alias("_of"), F.col("_hash").alias("_of_hash")).agg(F.collect_set(entry).alias("_found"))
    both = rows.join(found, F.col(doc).eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("_of_hash")), "left")
    old = F.transform("tokens", lambda t, i: F.struct(i.alias("_pos"), F.lit(0).alias("_new"), t.alias("token")))

    def latest(entries: Column) -> Column:
        """The last entry of every position."""
        kept = F.filter(entries, lambda e, i: ~F.coalesce(F.get(entries, i + 1)["_pos"] == e["_pos"], F.lit(False)))
        return F.transform(kept, lambda e: e["token"])

    changed = let(F.sort_array(F.concat(old, "_found")), latest)
    return both.select(doc, F.when(F.col("_found").isNull(), F.col("tokens")).otherwise(changed).alias("tokens"))
