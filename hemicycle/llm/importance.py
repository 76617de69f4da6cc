"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .anchors import Kind, chunks, units
from .common import text_of, token_hash

#: Words are the units of the models.
_WORDS = Kind(by_word=True, length=1, gram=1)
#: Scores are ordered in steps of this size.
STEP = 1e-6
#: Bins of a round of the search for a rank.
BINS = 4096


@dataclass(frozen=True)
class Sampler:
    """``buckets`` of words and pairs of words, hashed; ``max_target`` labelled documents, chosen
    by a hash of their id, fit the target model. The log weight of a document is the log ratio
    of the two models for it, the sum over its n-grams, divided by ``temperature``."""

    buckets: int = 10_000
    max_target: int = 20_000
    temperature: float = 1.0
    seed: int = 11


def ngram_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of neighbouring words, and the index of their text.

    ASCII letters are lower-cased; words end at ASCII white space.
    """
    hashes, begins = units([t.lower() for t in texts], _WORDS)
    at = np.arange(int(begins[-1]), dtype=np.int64)
    text = np.searchsorted(begins, at, side="right") - 1
    pairs = at[: max(0, len(at) - 1)]
    pairs = pairs[text[pairs] == text[pairs + 1]] if len(pairs) else pairs
    grams = np.concatenate([hashes.of(at, at + 1), hashes.of(pairs, pairs + 2)])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([text, text[pairs]])


def log_ratios(docs: DataFrame, target: DataFrame, sampler: Sampler, doc_id: str, text: str) -> np.ndarray:
    """Log of target over raw probability of each bucket, with one added to every count.

    The raw model counts all documents, the target model those whose id is in ``target``
    (one column, ``max_target`` rows at most, so it is broadcast). A task sums up its
    documents before it sends ``buckets`` numbers.
    """
    flagged = target.select(F.col(target.columns[0]).alias("of"), F.lit(True).alias("wanted")).distinct()
    texts = docs.select(docs[doc_id].alias("id"), text_of(text).cast("binary").alias("data"))
    texts = texts.join(F.broadcast(flagged), F.col("id") == F.col("of"), "left").select("data", "wanted")
    buckets = sampler.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            flags = np.array([bool(f) for f in batch.column(1).to_pylist()], dtype=bool)
            for first, some in chunks(batch.column(0).to_pylist()):
                found, of = ngram_buckets(some, buckets)
                raw += np.bincount(found, minlength=buckets)
                wanted += np.bincount(found[flags[first + of]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(raw), pa.array(wanted)],
                                         names=["bucket", "raw", "wanted"])

    counts = texts.mapInArrow(count, "bucket long, raw long, wanted long").groupBy("bucket")
    got = counts.agg(F.sum("raw").alias("raw"), F.sum("wanted").alias("wanted")).collect()
    raw, wanted = np.ones(buckets), np.ones(buckets)
    for row in got:
        raw[row.bucket] += row.raw
        wanted[row.bucket] += row.wanted
    return np.log(wanted / wanted.sum()) - np.log(raw / raw.sum())


def scores(docs: DataFrame, ratios: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_grams, log_ratio`` (sum over the n-grams, zero without any)."""
    texts = docs.select(docs[doc_id].alias("doc_id"), text_of(text).cast("binary").alias("data"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = batch.column(1).to_pylist()
            total, n = np.zeros(len(texts_)), np.zeros(len(texts_), dtype=np.int64)
            for first, some in chunks(texts_):
                found, of = ngram_buckets(some, len(ratios))
                part = slice(first, first + len(some))
                total[part] = np.bincount(of, weights=ratios[found], minlength=len(some))
                n[part] = np.bincount(of, minlength=len(some))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total)],
                                             names=["doc_id", "n_grams", "log_ratio"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return texts.mapInArrow(score, f"doc_id {kind}, n_grams long, log_ratio double")


def gumbel(seed: object, key: Column) -> Column:
    """Gumbel noise from a hash of the key."""
    uniform = (token_hash(f"{seed}:gumbel", key) + F.lit(0.5)) / F.lit(float(1 << 60))
    return -F.log(-F.log(uniform))


def rank_value(rows: DataFrame, column: str, k: int) -> int | None:
    """The ``k``-th largest value of a whole-number column; None if there are fewer rows.

    The range is cut into bins that are counted, then the bin that holds the rank, and so
    on: some numbers per round reach the driver, and no rows are sorted.
    """
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or not n or n < k:
        return None
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = rows.where(F.col(column).between(low, high))
        bins = inside.groupBy(F.expr(f"({column} - {low}) div {width}").alias("bin")).count().collect()
        for bin_, count in sorted(((r["bin"], r["count"]) for r in bins), reverse=True):
            if count >= k:
                low, high = low + bin_ * width, min(high, low + (bin_ + 1) * width - 1)
                break
            k -= count
    return low


def importance_sample(docs: DataFrame, target: DataFrame, share: float, sampler: Sampler = Sampler(),
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_grams, log_ratio, score, kept``.

    ``target`` holds ids of documents of the wanted kind. A document's log weight is the
    log ratio of the target and the raw model for all its n-grams; with Gumbel noise added, the ``share`` of documents with the
    highest scores is a sample without replacement by weight. Scores are compared in steps
    of ``STEP``, then by a hash of the id, then as equals: rows that repeat an id and a
    text are kept or left together. A text without words has log ratio zero; null ids share
    one noise; an empty table gives an empty result; without any target documents the
    models differ only by what is common. Other columns are not read.
    """
    ids = target.select(F.col(target.columns[0]).alias("id")).where("id is not null").distinct()
    chosen = ids.orderBy(token_hash(f"{sampler.seed}:target", F.col("id")), "id").limit(sampler.max_target)
    ratios = log_ratios(docs, chosen, sampler, doc_id, text)
    rows = scores(docs, ratios, doc_id, text)
    rows = rows.withColumn("score", F.col("log_ratio") / sampler.temperature + gumbel(sampler.seed, F.col("doc_id")))
    rows = rows.withColumn("_step", F.floor(F.col("score") / STEP).cast("long"))
    rows = stored(rows.withColumn("_tie", token_hash(sampler.seed, F.col("doc_id"))), "scores")
    n = rows.count()
    k = round(share * n)
    last = rank_value(rows, "_step", k)
    if last is None:
        kept = F.lit(k >= n)
    else:
        ahead = rows.where(F.col("_step") > last).count()
        tie = rank_value(rows.where(F.col("_step") == last), "_tie", k - ahead)
        kept = (F.col("_step") > last) | ((F.col("_step") == last) & (F.col("_tie") >= F.lit(tie)))
    return rows.select("doc_id", "n_grams", "log_ratio", "score", kept.alias("kept"))
