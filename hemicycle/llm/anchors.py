"""Candidates for repeated windows: anchors, spans, and what settles them.

A window is ``length`` consecutive units (words or bytes) of one document. Its anchor is the
``gram`` units of it with the smallest hash, the first of equals. Equal windows have equal
anchors, so a window whose anchor occurs once in the corpus cannot be repeated. The windows of
one document that share an anchor occurrence start side by side; together they form a span.

Spans that are equal as a whole settle all their windows in one row. What remains is one
copy of each of several different spans over one anchor; their windows are for the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Bytes of text whose hashes are held at once (one longer text is held whole).
CHUNK = 1 << 21
#: An anchor with more rows than this is dealt by its spans as well; rises with the table
#: so that there are at most MAX_HOT such anchors. They are found in one text out of SAMPLE.
HOT_ROWS, MAX_HOT, SAMPLE = 4096, 100_000, 64

ROWS = "doc_id long, text_hash long, anchor long, span long, start int, more int, n long, done boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("anchor", pa.int64()), ("span", pa.int64()),
                    ("start", pa.int32()), ("more", pa.int32()), ("n", pa.int64()), ("done", pa.bool_())])

_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


@dataclass(frozen=True)
class Kind:
    """Units and lengths. ``by_word``: words between ASCII white space, else bytes."""

    by_word: bool
    length: int
    gram: int


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each number spread over all of it."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Hashes:
    """Hash of any run of units: a sum over powers of an odd number, shifted back by its inverse."""

    def __init__(self, values: np.ndarray):
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _powers(_BASE, len(values))[:-1], dtype=np.uint64)])
        self.back = _powers(_INVERSE, len(values))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def units(texts: list[bytes], kind: Kind) -> tuple[Hashes, np.ndarray]:
    """Hashes over the units of all texts in a row, and where each text begins (one more at the end)."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    values = _byte_values()[data]
    if not kind.by_word:
        return Hashes(values), begins
    inside = ~_SPACES[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    cuts = begins[:-1][begins[:-1] < len(data)]
    fresh[cuts] = inside[cuts]
    starts = np.flatnonzero(fresh)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:]
    words = Hashes(values).of(starts, np.flatnonzero(last) + 1)
    return Hashes(words), np.searchsorted(starts, begins)


def _first_of_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every ``width`` neighbours, by windows of doubled width."""
    have = 1
    while have < width:
        step = min(have, width - have)
        keys = np.minimum(keys[: len(keys) - step], keys[step:])
        have += step
    return keys


def spans(texts: list[bytes], kind: Kind) -> tuple[np.ndarray, ...]:
    """Spans of the texts: index of the text, first start in it, further starts, anchor, hash of the span."""
    hashes, begins = units(texts, kind)
    total = int(begins[-1])
    if total < kind.length:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    at = np.arange(total - kind.gram + 1, dtype=np.int64)
    grams = hashes.of(at, at + kind.gram)
    low = np.uint64((1 << int(total).bit_length()) - 1)
    least = _first_of_least((grams & ~low) | at.astype(np.uint64), kind.length - kind.gram + 1)
    anchor = (least & low).astype(np.int64)  # of the window that starts here
    counts = np.diff(begins)
    room = np.maximum(counts - kind.length + 1, 0)
    text = np.repeat(np.arange(len(texts)), room)
    start = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room)
    whole = start + begins[:-1][text]
    fresh = np.ones(len(text), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (anchor[whole[1:]] != anchor[whole[:-1]])
    first = np.flatnonzero(fresh)
    n_starts = np.diff(np.append(first, len(text)))
    a = whole[first]
    # The place of the anchor in the span belongs to the span.
    place = (anchor[a] - a).astype(np.uint64)
    span = mixed(hashes.of(a, a + n_starts - 1 + kind.length) + place)
    return text[first], start[first], n_starts - 1, grams[anchor[a]], span


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of ``CHUNK`` bytes or a little more, with the index of the first."""
    first, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= CHUNK:
            yield first, texts[first : k + 1]
            first, held = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def collapsed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of numbers: how often each occurs, given at its first place; whether a place is a later one."""
    if not len(x):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
    order = np.lexsort((y, x))
    fresh = np.ones(len(x), dtype=bool)
    fresh[1:] = (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
    first = np.flatnonzero(fresh)
    times = np.ones(len(x), dtype=np.int64)
    times[order[first]] = np.diff(np.append(first, len(x)))
    later = np.ones(len(x), dtype=bool)
    later[order[first]] = False
    return times, later


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text_hash, text``: rows equal in the first two have equal texts and get equal results."""
    content = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(content).alias("text_hash"),
                       content.cast("binary").alias("text"))


def _anchor_rows(kind: Kind) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = []
            for first, some in chunks(texts):
                text, *rest = spans(some, kind)
                found.append((text + first, *rest))
            text, start, more, anchor, span = (np.concatenate(c) for c in zip(*found, strict=True))
            n, later = collapsed(anchor.astype(np.uint64), span.astype(np.uint64))
            rows_of = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows_of), batch.column(1).take(rows_of),
                 pa.array(anchor.astype(np.uint64).view(np.int64)), pa.array(span.astype(np.uint64).view(np.int64)),
                 pa.array(start.astype(np.int32)), pa.array(more.astype(np.int32)), pa.array(n), pa.array(later)],
                schema=_ARROW,
            )

    return rows


def candidates(texts: DataFrame, kind: Kind, name: str) -> tuple[DataFrame, DataFrame]:
    """``settled`` and ``open`` spans of ``keyed`` texts.

    Both have ``doc_id, text_hash, start, more``: windows start at ``start`` and at the next
    ``more`` units. Those of settled spans are repeated. ``open`` has one copy of each span
    whose anchor has several different spans, settled or not, with ``anchor`` and ``hot``.

    A task collapses equal spans of an Arrow batch before the shuffle, so a passage that
    every document holds sends one row per batch. All rows of an anchor meet in one task,
    but for hot anchors: those are dealt by their spans, and all of these count as open.
    """
    rows = stored(texts.mapInArrow(_anchor_rows(kind), ROWS), f"{name}-anchors")
    sent = rows.where("not done")
    limit = max(HOT_ROWS, -(-rows.count() // MAX_HOT))
    often = sent.where(F.pmod("text_hash", F.lit(SAMPLE)) == 0).groupBy("anchor").count()
    # At most MAX_HOT rows, as each stands for more than `limit` of the rows.
    hot = F.broadcast(often.where(F.col("count") * SAMPLE > limit).select("anchor", F.lit(True).alias("hot")))
    dealt = sent.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    dealt = dealt.withColumn("part", F.when(F.col("hot"), F.pmod("span", F.lit(1024))).otherwise(0))
    of_anchor = Window.partitionBy("anchor", "part")
    of_span = Window.partitionBy("anchor", "part", "span")
    dealt = dealt.select(
        "doc_id", "text_hash", "start", "more", "anchor", "hot",
        (F.sum("n").over(of_span) > 1).alias("settled"),
        (F.row_number().over(of_span.orderBy("doc_id", "text_hash", "start")) == 1).alias("first"),
        (F.col("hot") | (F.min("span").over(of_anchor) != F.max("span").over(of_anchor))).alias("several"),
    ).where("settled or several")
    dealt = stored(dealt, f"{name}-spans")
    place = ["doc_id", "text_hash", "start", "more"]
    settled = rows.where("done").select(place).unionByName(dealt.where("settled").select(place))
    return settled, dealt.where("several and first").select(*place, "anchor", "hot")


def same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))


def by_document(spans_: DataFrame, *columns: str) -> DataFrame:
    """``of_id, of_hash, spans``: all spans of a document as one sorted array."""
    gathered = spans_.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
    return gathered.agg(F.sort_array(F.collect_set(F.struct(*columns))).alias("spans"))
