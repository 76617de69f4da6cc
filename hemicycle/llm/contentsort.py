"""Exact deduplication by content sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import text_of, whole_rows, without_space

#: Leading characters of a text that take part in the choice of splitters.
PREFIX = 64
#: Rows of one text that a task sorts; a text with more copies is dealt to several tasks.
RUN_ROWS = 1_000
#: Most texts that can be dealt to several tasks; ``RUN_ROWS`` rises with the table to keep to it.
MAX_SPLIT = 100_000

KEYS = ("prefix", "digest", "salt", "content")


def _sorted(rows: DataFrame, run_rows: int) -> DataFrame:
    """``rows`` (``doc_id``, ``text``, ...) in runs of equal content.

    Splitters are sampled over the first characters of the content, then its hash, so that
    texts with one beginning still spread and the sample stays small. Equal contents are
    neighbours after the sort, and only whole equal contents share a run. A text with more
    than ``run_rows`` copies is cut by document id into as many runs as it needs; ``salts``
    says how many.
    """
    content = without_space(F.col("text"))
    digest = F.xxhash64(content)
    run_rows = max(run_rows, -(-rows.count() // MAX_SPLIT))
    copies = rows.select(digest.alias("digest")).groupBy("digest").count().where(F.col("count") > run_rows)
    # At most MAX_SPLIT rows of 16 bytes.
    split = F.broadcast(copies.select("digest", F.ceil(F.col("count") / run_rows).alias("salts")))
    keyed = rows.select("*", F.substring(content, 1, PREFIX).alias("prefix"), digest.alias("digest"))
    keyed = keyed.join(split, "digest", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(F.lit("salt"), "doc_id"), F.col("salts"))
    ranged = keyed.withColumn("salt", salt).repartitionByRange("prefix", "digest", "salt")
    # The windows below are partitioned by these columns and the content: no further shuffle.
    return ranged.withColumn("content", without_space(F.col("text"))).withColumn("n_chars", F.length("text"))


def _best_first() -> list[Column]:
    return [F.desc("n_chars"), F.asc_nulls_last("doc_id")]


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical without their white space; null counts as empty.
    Of equal texts the one with the most characters stays, then the one with the smallest
    id (null last); of rows that repeat an id and a text one stays. An empty table gives an
    empty result. Other input columns are not read.

    Runs compare whole contents. Runs of one text that was cut by ``run_rows`` meet again
    by their SHA-256.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), text_of(text).alias("text"))
    ordered = Window.partitionBy(*KEYS).orderBy(*_best_first())
    whole = Window.partitionBy(*KEYS)
    runs = _sorted(rows, run_rows).select(
        "doc_id",
        "salt",
        "salts",
        F.sha2("content", 256).alias("text_sha256"),
        F.first("doc_id").over(ordered).alias("keep_id"),
        F.first("n_chars").over(ordered).alias("n_chars"),
        F.count("*").over(whole).alias("group_size"),
        (F.row_number().over(ordered) == 1).alias("kept"),
    )
    runs = stored(runs, "content-runs")
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    # Cut texts: one row per run, at most `salts` of a text.
    by_text = Window.partitionBy("text_sha256")
    best = by_text.orderBy(F.desc("n_chars"), F.asc_nulls_last("keep_id"), "salt")
    heads = runs.where("kept and salts > 1").select(
        "text_sha256",
        "salt",
        F.first("keep_id").over(best).alias("best_id"),
        F.sum("group_size").over(by_text).alias("all_rows"),
        (F.row_number().over(best) == 1).alias("wins"),
    )
    cut = runs.where("salts > 1").join(heads, ["text_sha256", "salt"])
    cut = cut.select("doc_id", F.col("best_id").alias("keep_id"), F.col("all_rows").alias("group_size"),
                     (F.col("kept") & F.col("wins")).alias("kept"), "text_sha256")
    return runs.where("salts = 1").select(out).unionByName(cut.select(out))


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          run_rows: int = RUN_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns."""
    rows = whole_rows(docs, doc_id=docs[doc_id], text=text_of(text))
    ordered = Window.partitionBy(*KEYS).orderBy(*_best_first())
    firsts = _sorted(rows, run_rows).withColumn("place", F.row_number().over(ordered)).where("place = 1")
    firsts = firsts.select("row", "doc_id", "n_chars", "salt", "salts", F.sha2("content", 256).alias("sha"))
    firsts = stored(firsts, "content-firsts")
    best = Window.partitionBy("sha").orderBy(*_best_first(), "salt")
    cut = firsts.where("salts > 1").withColumn("place", F.row_number().over(best)).where("place = 1")
    return firsts.where("salts = 1").select("row.*").unionByName(cut.select("row.*"))
