"""Suffix edits learnt from a lemma table, for the words it lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Suffixes of at most ``SHORT`` characters are few but end very many words: their join keys are dealt over ``SALTS``.
SHORT, SALTS = 2, 64


def _shared_prefix(a: Column, b: Column) -> Column:
    lengths = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.array_max(F.filter(lengths, lambda p: F.left(a, p) == F.left(b, p)))


def _suffixes(word: Column, max_suffix: int) -> Column:
    """Proper suffixes of at most ``max_suffix`` characters; a word of one character has none."""
    lengths = F.sequence(F.lit(0), F.least(F.length(word) - 1, F.lit(max_suffix)))
    return F.when(F.length(word) > 1, F.transform(F.filter(lengths, lambda n: n > 0), lambda n: F.right(word, n)))


def learn_rules(lemmas: DataFrame, max_suffix: int = 5, min_count: int = 2, min_share: float = 0.5) -> DataFrame:
    """``(suffix, cut, added, count, share)``: the edit that most words with a suffix take.

    An edit drops the last ``cut`` characters of a word and appends ``added``. It counts for every
    suffix of the word that holds all it drops; for shorter ones the word only counts in the whole. A
    rule needs ``min_count`` words and ``min_share`` of the words with that suffix; ties go to the edit that
    drops less, then to the smaller text. Rows of ``(word, lemma)`` that repeat count once, a word with two
    lemmas counts for both; rows with a null or an empty word are left out. Only counts are shuffled.
    """
    word, lemma = F.col("word"), F.col("lemma")
    pairs = lemmas.select("word", "lemma").filter(word.isNotNull() & lemma.isNotNull() & (word != "")).distinct()
    edits = pairs.withColumn("_p", _shared_prefix(word, lemma)).select(
        F.explode(_suffixes(word, max_suffix)).alias("suffix"),
        (F.length(word) - F.col("_p")).alias("cut"),
        F.substr(lemma, F.col("_p") + 1).alias("added"),
    )
    held = F.col("cut") <= F.length("suffix")
    counted = (
        edits.select("suffix", F.when(held, F.struct("cut", "added")).alias("edit"))
        .groupBy("suffix", "edit")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.struct((-F.col("n")).alias("n"), F.col("edit.cut").alias("cut"), F.col("edit.added").alias("added"))
    best = counted.groupBy("suffix").agg(
        F.min(F.when(F.col("edit").isNotNull(), first)).alias("b"), F.sum("n").alias("total")
    )
    rules = best.filter(F.col("b").isNotNull()).select(
        "suffix", F.col("b.cut").alias("cut"), F.col("b.added").alias("added"), (-F.col("b.n")).alias("count"),
        (-F.col("b.n") / F.col("total")).alias("share"),
    )
    return rules.filter((F.col("count") >= min_count) & (F.col("share") >= min_share))


def rule_lemmas(words: DataFrame, rules: DataFrame, max_suffix: int = 5) -> DataFrame:
    """``(word, lemma, suffix)`` per different word, by the rule of its longest suffix; nulls where none fits.

    Null words are left out. ``max_suffix`` is that of the rules. Words with the same short suffix are
    spread over several keys, to which the rules of short suffixes are repeated.
    """
    short = F.length("suffix") <= SHORT
    salt = F.when(short, F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(short, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    distinct = words.select("word").filter(F.col("word").isNotNull()).distinct()
    tried = distinct.select("word", F.explode_outer(_suffixes(F.col("word"), max_suffix)).alias("suffix"))
    salted = rules.select("suffix", "cut", "added", F.explode(salts).alias("_salt"))
    found = tried.withColumn("_salt", salt).join(salted, ["suffix", "_salt"], "left")
    rule = F.when(F.col("cut").isNotNull(), F.struct(F.length("suffix").alias("size"), "suffix", "cut", "added"))
    longest = found.groupBy("word").agg(F.max(rule).alias("r"))
    stem = F.left(F.col("word"), F.length("word") - F.col("r.cut"))
    return longest.select("word", F.concat(stem, F.col("r.added")).alias("lemma"), F.col("r.suffix").alias("suffix"))


def complete_lemmas(lemmas: DataFrame, words: DataFrame, rules: DataFrame, max_suffix: int = 5) -> DataFrame:
    """The lemma table with a row for every word that it lacks and a rule fits."""
    lacking = words.select("word").join(lemmas.select("word"), "word", "left_anti")
    ruled = rule_lemmas(lacking, rules, max_suffix).filter(F.col("lemma").isNotNull())
    return lemmas.select("word", "lemma").unionByName(ruled.select("word", "lemma"))
