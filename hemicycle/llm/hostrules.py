"""Quality rules per document, and verdicts on the hosts that break them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import SPACE, let, text_of, whole_rows, without_space, words_of


@dataclass(frozen=True)
class Limits:
    """A document shorter than ``min_words``, or with more than ``max_repeat_pct`` per cent
    of its words in repeated windows, fails by itself. The other two shares only count
    towards the verdict on a host. A host is rejected if the shrunk rate of any rule is
    over ``max_host_rate``."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    max_host_rate: float = 0.5


RULES = ("short", "repetitive", "symbols", "dup_lines")


def repeat_words(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more among ``words``.

    Windows are hashed, the hash is packed with the position and sorted as one number;
    windows whose packed hash has an equal neighbour are compared again by their words.
    """

    def positions(w: Column, n: Column) -> Column:
        # As many low bits as a position needs; the rest stays with the hash.
        low = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n)))
        packed = F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(-low) + i,
        )
        twins = let(
            F.sort_array(packed),
            lambda s: F.filter(
                s,
                lambda x, k: (
                    F.coalesce(x.bitwiseAND(-low) == F.get(s, k - 1).bitwiseAND(-low), F.lit(False))
                    | F.coalesce(x.bitwiseAND(-low) == F.get(s, k + 1).bitwiseAND(-low), F.lit(False))
                ),
            ),
        )
        windows = F.transform(
            F.transform(twins, lambda x: x.bitwiseAND(low - 1).cast("int")),
            lambda i: F.struct(
                F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("words"), i.alias("at")
            ),
        )
        same = let(
            F.sort_array(windows),
            lambda s: F.filter(
                s,
                lambda x, k: (
                    F.coalesce(x["words"] == F.get(s, k - 1)["words"], F.lit(False))
                    | F.coalesce(x["words"] == F.get(s, k + 1)["words"], F.lit(False))
                ),
            ),
        )
        return F.sort_array(F.transform(same, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(
        let(positions(w, F.size(w)), covered)))


def _measures(text: Column) -> dict[str, Column]:
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE[1:]}"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(without_space(text)).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_repeat_words": repeat_words(words),
    }


def _failures(limits: Limits) -> dict[str, Column]:
    n, lines = F.col("n_words"), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "short": n < limits.min_words,
        "repetitive": 100 * F.col("n_repeat_words") > limits.max_repeat_pct * n,
        "symbols": 100 * F.col("n_symbols") > limits.max_symbol_pct * n,
        "dup_lines": 100 * F.col("n_dup_lines") > limits.max_dup_line_pct * lines,
    }


def document_rules(rows: DataFrame, limits: Limits) -> DataFrame:
    """Measures and broken rules of every row, in place of its ``text``."""
    rows = rows.select("*", *[c.alias(n) for n, c in _measures(F.col("text")).items()])
    rows = rows.select("*", *[c.alias(n) for n, c in _failures(limits).items()])
    return rows.withColumn("base_failed", F.col("short") | F.col("repetitive")).drop("text")


def rejected_hosts(rules: DataFrame, limits: Limits) -> DataFrame:
    """``host`` and the shrunk failure rate of each rule, for hosts where one is too high.

    A rule's rates over all hosts give a beta prior by its first two moments (each host
    counts once). A host's rate is the posterior mean. Without spread between hosts the
    prior decides alone; a spread wider than any beta law leaves the rates as they are.
    """
    fails = [F.sum(F.col(r).cast("long")).alias(r) for r in RULES]
    hosts = stored(rules.groupBy("host").agg(F.count("*").alias("n"), *fails), "hosts")
    moments = hosts.agg(*[f(F.col(r) / F.col("n")).alias(f"{k}_{r}") for r in RULES
                          for k, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    rates = []
    for r in RULES:
        mean, var = moments[f"mean_{r}"] or 0.0, moments[f"var_{r}"] or 0.0
        if var == 0:
            rates.append(F.lit(mean).alias(r))
        else:
            strength = max(0.0, mean * (1 - mean) / var - 1)
            rates.append(((F.col(r) + mean * strength) / (F.col("n") + strength)).alias(r))
    bad = F.greatest(*[F.col(r) for r in RULES]) > limits.max_host_rate
    return hosts.select("host", *rates).where(bad)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                  limits: Limits = Limits()) -> DataFrame:
    """One row per document: ``doc_id``, its measures, ``base_failed`` and ``kept``.

    A null text has no words and fails; a null host is a host of its own; repeated rows are
    judged one by one; an empty table gives an empty result. Other columns are not read.
    ``kept`` is false if the document fails by itself or its host is rejected.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[host].alias("host"), text_of(text).alias("text"))
    rules = stored(document_rules(rows, limits), "document-rules")
    hosts = rejected_hosts(rules, limits).select(F.col("host").alias("bad_host"), F.lit(True).alias("rejected"))
    judged = rules.join(hosts, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    kept = ~F.col("base_failed") & F.col("rejected").isNull()
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    The texts are measured twice, once for the hosts and once for the rows: cheaper than
    storing them.
    """
    rows = document_rules(whole_rows(docs, host=docs[host], text=text_of(text)), limits)
    bad = rejected_hosts(rows.drop("row"), limits).select(F.col("host").alias("bad_host"))
    good = rows.where(~F.col("base_failed")).select("row", "host")
    return good.join(bad, F.col("host").eqNullSafe(F.col("bad_host")), "left_anti").select("row.*")
