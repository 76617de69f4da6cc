"""Mixing sources to target weights by temperature."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import text_of, token_hash, whole_rows, words_of

#: A budget of as many tokens as the table has.
ALL = -1
#: Halvings of the exponent's range: rounds of one pass over the sources, and halvings per round.
ROUNDS, HALVINGS = 5, 6
#: Slices of a source's permutation; each is ordered by itself.
SLICES = 1 << 14
#: Bits of a slice's number within its stretch of neighbouring slices; stretches are summed up first.
STRETCH_BITS = 7
HASH_BITS = 60


@dataclass(frozen=True)
class Mix:
    """``p ** exponent`` of the source shares ``p`` gives the weights, 0 <= exponent <= 1.

    ``entropy_share``: the largest exponent whose weights have at least this share of the
    highest possible entropy. ``max_epochs``: the smallest exponent at which no source is
    read more often than this. One of the two is given. ``budget``: tokens to draw, ``ALL``
    for as many as there are; None takes as many as read every source once at least.
    """

    entropy_share: float | None = None
    max_epochs: float | None = None
    budget: int | None = None
    block_tokens: int = 1 << 20
    seed: int = 7


def _fits(mix: Mix, exponent: float, total: int, n: int, sums: tuple[float, float], least: float, most: float) -> bool:
    """Whether the weights at an exponent meet the target. ``sums``: of p**a and of p**a * ln p."""
    z, zl = sums
    budget = total if mix.budget == ALL else mix.budget
    if mix.entropy_share is not None:
        return math.log(z) - exponent * zl / z >= mix.entropy_share * math.log(n)
    if budget is None:
        return (most / least) ** (1 - exponent) <= mix.max_epochs
    return budget / total * least ** (exponent - 1) / z <= mix.max_epochs


def exponent_for(sources: DataFrame, mix: Mix) -> float:
    """Bisected exponent for a table of ``source, tokens``; sources without tokens do not count.

    Each round sums the table at all exponents that its next halvings could ask for, so
    only a few numbers reach the driver however many sources there are.
    """
    if (mix.entropy_share is None) == (mix.max_epochs is None):
        raise ValueError("give either entropy_share or max_epochs")
    some = sources.where("tokens > 0")
    total, n, low, high = some.agg(F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")).first()
    if not n:
        return 1.0
    share = F.col("tokens") / F.lit(total).cast("double")

    def fits_at(exponents: list[float]) -> list[bool]:
        powers = [F.pow(share, F.lit(a)) for a in exponents]
        got = some.agg(*[F.sum(p) for p in powers], *[F.sum(p * F.log(share)) for p in powers]).first()
        pairs = zip(exponents, got[: len(powers)], got[len(powers) :], strict=True)
        return [_fits(mix, a, total, n, (z, zl), low / total, high / total) for a, z, zl in pairs]

    # The end that is wanted if it fits: proportional weights for entropy, even ones for epochs.
    at_zero, at_one = fits_at([0.0, 1.0])
    if mix.entropy_share is not None and at_one:
        return 1.0
    if mix.max_epochs is not None and (at_zero or not at_one):
        return 0.0 if at_zero else 1.0
    below, above = 0.0, 1.0
    for _ in range(ROUNDS):
        parts = 1 << HALVINGS
        grid = [below + (above - below) * k / parts for k in range(parts + 1)]
        known = fits_at(grid[1:-1])
        i, j = 0, parts
        while j - i > 1:
            mid = (i + j) // 2
            low_side = known[mid - 1] == (mix.max_epochs is not None)
            i, j = (i, mid) if low_side else (mid, j)
        below, above = grid[i], grid[j]
    return below if mix.entropy_share is not None else above


def source_plan(sources: DataFrame, mix: Mix) -> DataFrame:
    """``source, tokens, target, epochs, rest``: tokens to draw, as whole epochs and a rest."""
    a = exponent_for(sources, mix)
    some = sources.where("tokens > 0")
    total = float(some.agg(F.sum("tokens")).first()[0] or 1)
    budget = total if mix.budget == ALL else mix.budget
    share = F.col("tokens") / F.lit(total)
    z, most = some.agg(F.sum(F.pow(share, F.lit(a))), F.max(share)).first()
    if budget is None:
        target = F.floor(F.col("tokens") * F.pow(F.lit(most or 1.0) / share, F.lit(1 - a)))
    else:
        target = F.round(F.pow(share, F.lit(a)) / F.lit(z or 1.0) * F.lit(float(budget)))
    # Nothing to weigh in a source without tokens: its documents are read once.
    full = F.col("tokens") > 0
    plan = sources.withColumn("target", F.when(full, target).otherwise(0).cast("long"))
    plan = plan.withColumn("epochs", F.when(full, F.expr("target div tokens")).otherwise(1))
    return plan.withColumn("rest", F.when(full, F.expr("target - epochs * tokens")).otherwise(0))


def _ahead(sums: str, group: list[str], order: str) -> Column:
    """Sum of a column over the rows of the group before this one."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(sums).over(before), F.lit(0))


def _drawn(rows: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """``rows`` (``doc_id, source, ticket, tokens``) with ``begin, until`` and their plan; the plan.

    A source's permutation is the order of ``ticket``. Tokens are summed per slice of it and
    per stretch of slices; stretches are summed up, then the slices of a stretch, and only
    then the rows of a slice: no task sees a whole source, nor all its slices.
    ``begin`` counts the tokens ahead of a row, ``until`` those up to the end of its ticket.
    """
    rows = rows.withColumn("slice", F.shiftright("ticket", HASH_BITS - SLICES.bit_length() + 1))
    slices = stored(rows.groupBy("source", "slice").agg(F.sum("tokens").alias("in_slice")), "mix-slices")
    sources = stored(slices.groupBy("source").agg(F.sum("in_slice").alias("tokens")), "mix-sources")
    plan = stored(source_plan(sources, mix), "mix-plan")
    slices = slices.withColumn("stretch", F.shiftright("slice", STRETCH_BITS))
    stretches = slices.groupBy("source", "stretch").agg(F.sum("in_slice").alias("in_stretch"))
    stretches = stretches.select(F.col("source").alias("of"), F.col("stretch").alias("far"),
                                 _ahead("in_stretch", ["source"], "stretch").alias("ahead"))
    slices = slices.join(stretches, F.col("source").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("far")))
    slices = slices.select(F.col("source").alias("of"), F.col("slice").alias("at"),
                           (F.col("ahead") + _ahead("in_slice", ["source", "stretch"], "slice")).alias("ahead"))
    rows = rows.join(slices, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    inside = Window.partitionBy("of", "at")
    tickets = inside.orderBy("ticket").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    places = inside.orderBy("ticket", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("doc_id", "source", "ticket", "tokens",
                       (F.col("ahead") + F.sum("tokens").over(tickets)).alias("until"),
                       (F.col("ahead") + F.sum("tokens").over(places) - F.col("tokens")).alias("begin"))
    of_plan = plan.select(F.col("source").alias("of"), F.col("tokens").alias("all_tokens"), "target", "epochs", "rest")
    return rows.join(of_plan, F.col("source").eqNullSafe(F.col("of"))).drop("of"), plan


def _tickets(docs: DataFrame, mix: Mix, doc_id: str, text: str, source: str) -> DataFrame:
    rows = docs.select(
        docs[doc_id].alias("doc_id"),
        docs[source].alias("source"),
        F.size(words_of(text_of(text))).cast("long").alias("tokens"),
        token_hash(mix.seed, docs[doc_id]).alias("ticket"),
    )
    return stored(rows, "mix-rows")


def mixed_copies(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text",
                 source: str = "source") -> DataFrame:
    """One row per document and time it is read: ``doc_id, source, n_tokens, copy, block, ticket``.

    Tokens are words. Every epoch of a source follows its permutation; ``block`` cuts the
    mixture into stretches of about ``block_tokens`` in which each source has its weight,
    and ``ticket`` orders a block. The last epoch stops before the ticket that would pass
    the source's budget. A null source is a source of its own, a null text has no tokens,
    rows that repeat an id are drawn together, sources without tokens are read once in
    block 0, and an empty table gives an empty result. Other columns are not read.
    """
    drawn, plan = _drawn(_tickets(docs, mix, doc_id, text, source), mix)
    n_blocks = max(1, -(-(plan.agg(F.sum("target")).first()[0] or 0) // mix.block_tokens))
    extra = ((F.col("rest") > 0) & (F.col("until") <= F.col("rest"))).cast("long")
    copies = drawn.withColumn("copies", F.col("epochs") + extra).where("copies > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    begin = (F.col("copy") * F.col("all_tokens") + F.col("begin")).cast("double")
    block = F.floor(begin / F.greatest(F.col("target"), F.lit(1)) * n_blocks)
    return copies.select(
        "doc_id",
        "source",
        F.col("tokens").alias("n_tokens"),
        "copy",
        F.least(block, F.lit(n_blocks - 1)).alias("block"),
        token_hash(f"{mix.seed}:order", F.col("copy"), F.col("doc_id")).alias("ticket"),
    )


def mix_rows(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", text: str = "text",
             source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed_copies`` reads it, with all their columns.

    Texts are not shuffled: the last epoch of a source ends at one ticket, so its plan is
    a row of three numbers.
    """
    drawn, plan = _drawn(_tickets(docs, mix, doc_id, text, source), mix)
    last = drawn.where("rest > 0 and until <= rest").groupBy("source").agg(F.max("ticket").alias("last_ticket"))
    last = last.withColumnRenamed("source", "of")
    plan = plan.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
    plan = stored(plan.select(F.col("source").alias("of"), "epochs", "last_ticket"), "mix-cuts")
    rows = whole_rows(docs, source=docs[source], ticket=token_hash(mix.seed, docs[doc_id]))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    extra = F.coalesce(F.col("ticket") <= F.col("last_ticket"), F.lit(False)).cast("long")
    copies = F.col("epochs") + extra
    times = F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))
    return rows.withColumn("_time", F.explode(times)).select("row.*")
