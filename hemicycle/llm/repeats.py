"""Removal of repeated windows: by level-wise doubling over words, by suffix intervals over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .anchors import Kind, by_document, candidates, chunks, collapsed, keyed, mixed, same_document, spans, units
from .intervals import repeated_starts

#: A window of 35 words, found by its 9-word anchor; names double from 9 to 18 to 35 words.
WORDS = Kind(by_word=True, length=35, gram=9)
#: Words of the level between anchor and window.
LEVEL = 18
#: A string of 400 bytes, found by its 200-byte anchor.
BYTES = Kind(by_word=False, length=400, gram=200)
#: Bytes of spans over which one suffix array is built; an anchor with twice as many is split by longer anchors.
ARRAY_BYTES = 1 << 19
#: Bytes of spans of one anchor that a task holds; an anchor with more, which would be a hot one, is settled by names of windows.
GROUP_BYTES = 1 << 24
#: Spans of it that are named at once.
NAMED = 2 * ARRAY_BYTES // (2 * BYTES.length - BYTES.gram)

_FOUND = "left long, right long, doc_id long, text_hash long, start int, more int, n long, done boolean"
_FOUND_ARROW = pa.schema([("left", pa.int64()), ("right", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
                          ("start", pa.int32()), ("more", pa.int32()), ("n", pa.int64()), ("done", pa.bool_())])
_SEGMENTS = "anchor long, doc_id long, text_hash long, start int, hot boolean, data binary"


def _joined(texts: DataFrame, spans: DataFrame, how: str, *columns: str) -> DataFrame:
    """``texts`` with an array ``spans`` of what belongs to them."""
    both = texts.join(by_document(spans, *columns), same_document(), how)
    return both.select("doc_id", "text_hash", "text", "spans")


def _starts(spans: list[dict], further: int = 0) -> np.ndarray:
    """All starts that spans of one document hold, in order, each once; ``further`` ones behind each span."""
    start = np.array([s["start"] for s in spans], dtype=np.int64)
    n = np.array([s["more"] for s in spans], dtype=np.int64) + 1 + further
    return np.unique(np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))


def window_names(data: bytes, starts: np.ndarray, length: int, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Names of windows of ``length`` by doubling: the name of a run is the pair of names of two runs of half
    its length that cover it; of the last pair both members are given."""
    hashes, _ = units([data], kind)

    def name(start: np.ndarray, length: int) -> np.ndarray:
        if length <= kind.gram:
            return hashes.of(start, start + length)
        half = (length + 1) // 2
        return joined_names(name(start, half), name(start + length - half, half))

    half = (length + 1) // 2
    return name(starts, half), name(starts + length - half, half)


def joined_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One name for a pair of names."""
    return mixed((left * np.uint64(0xD6E8FEB86659FD93)) ^ (right + (left >> np.uint64(29))))


def _name_batch(ids: list, hashes: list, starts: list[np.ndarray], names: list[tuple]) -> pa.RecordBatch:
    """Rows of named windows; equal ones of the batch are collapsed into one with their number."""
    sizes = [len(s) for s in starts]
    left = np.concatenate([n[0] for n in names]) if names else np.empty(0, np.uint64)
    right = np.concatenate([n[1] for n in names]) if names else np.empty(0, np.uint64)
    n, later = collapsed(left, right)
    rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    flat = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(left.view(np.int64)), pa.array(right.view(np.int64)), pa.array(ids, pa.int64()).take(rows),
         pa.array(hashes, pa.int64()).take(rows), pa.array(flat.astype(np.int32)), pa.array(np.zeros(len(flat), np.int32)),
         pa.array(n), pa.array(later)],
        schema=_FOUND_ARROW,
    )


def _repeated_names(named: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, more`` of what is done or has a name that occurs twice or more.

    Names are counted first, so a name of any frequency sends one row per task, and the rows
    are joined with the counts, where Spark splits frequent names.
    """
    often = named.where("not done").groupBy("left", "right").agg(F.sum("n").alias("all")).where("all > 1")
    met = named.where("not done").join(often.drop("all"), ["left", "right"], "left_semi")
    columns = ["doc_id", "text_hash", "start", "more"]
    return named.where("done").select(columns).unionByName(met.select(columns))


def _level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the ``LEVEL``-word windows inside the spans of each document."""
    for batch in batches:
        starts, names = [], []
        for text, spans in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
            starts.append(_starts(spans, WORDS.length - LEVEL))
            name = joined_names(*window_names(text.as_py(), starts[-1], LEVEL, WORDS))
            names.append((name, np.zeros(len(name), np.uint64)))
        yield _name_batch(batch.column(0).to_pylist(), batch.column(1).to_pylist(), starts, names)


def repeated_words(texts: DataFrame) -> DataFrame:
    """Starts of repeated 35-word windows of ``keyed`` texts: ``doc_id, text_hash, start, more``.

    Level one: 9-word windows, as anchors; only those that occur again go on. Equal spans
    of 35-word windows over them are settled as a whole. Level two: the 18-word windows in
    the other spans are named and counted, and those that occur once go. Level three: two
    windows that are left, 17 words apart in one document, make a window of 35 words, named
    by the pair of their names; texts are not read again. Those that occur again are returned.
    """
    settled, open_ = candidates(texts, WORDS, "words")
    names = stored(_joined(texts, open_, "inner", "start", "more").mapInArrow(_level, _FOUND), "level-names")
    # Equal names of a batch are one row with their number, so one shuffle counts and returns them.
    often = names.where("not done").withColumn("all", F.sum("n").over(Window.partitionBy("left"))).where("all > 1")
    place = ["doc_id", "text_hash", "start", "left"]
    left = stored(names.where("done").select(place).unionByName(often.select(place)), "level-left")
    right = left.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), F.col("left").alias("right"),
                        (F.col("start") - (WORDS.length - LEVEL)).alias("of_start"))
    pairs = left.join(right, same_document() & (F.col("start") == F.col("of_start")))
    pairs = pairs.select("doc_id", "text_hash", "start", F.lit(0).alias("more"), "left", "right", F.lit(1).cast("long").alias("n"),
                         F.lit(False).alias("done"))
    return settled.unionByName(_repeated_names(pairs))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the spans of each document that an array can hold."""
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc_id, text_hash, text, spans in zip(ids, hashes, batch.column(2), batch.column(3).to_pylist(), strict=True):
            data = text.as_py()
            for s in spans:
                row = (s["anchor"], doc_id, text_hash, s["start"], s["hot"], data[s["start"] : s["start"] + s["more"] + BYTES.length])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                         names=["anchor", "doc_id", "text_hash", "start", "hot", "data"])


def _starts_of_large(parts: list[bytes], gram: int) -> list[np.ndarray]:
    """As ``repeated_starts`` of ``BYTES.length``, for parts of more bytes than one suffix array takes.

    Longer anchors cut each part into shorter spans. Equal ones are settled as a whole and one copy stays; one
    over an anchor that no other has holds nothing repeated. What is left meets by its anchor again, in arrays of
    ``ARRAY_BYTES``, with longer anchors where those are still too many bytes; an anchor as long as the
    string leaves nothing.
    """
    gram = (gram + BYTES.length + 1) // 2
    found = []
    for first, some in chunks(parts):
        part, *rest = spans(some, Kind(by_word=False, length=BYTES.length, gram=gram))
        found.append((part + first, *rest))
    part, start, more, anchor, span = (np.concatenate(c) for c in zip(*found, strict=True))
    times, later = collapsed(anchor, span)
    equal = (times > 1) | later
    out: list[list[np.ndarray]] = [[] for _ in parts]
    for p, s, m in zip(part[equal].tolist(), start[equal].tolist(), more[equal].tolist(), strict=True):
        out[p].append(np.arange(s, s + m + 1))
    one = np.flatnonzero(~later)
    one = one[np.argsort(anchor[one], kind="stable")]
    cuts = np.flatnonzero(anchor[one][1:] != anchor[one][:-1]) + 1
    several = [g for g in np.split(one, cuts) if len(g) > 1]

    def search(places: list[int], searched: list[np.ndarray]) -> None:
        for k, starts in zip(places, searched, strict=True):
            out[part[k]].append(starts + start[k])

    def data(places: list[int]) -> list[bytes]:
        return [parts[part[k]][start[k] : start[k] + more[k] + BYTES.length] for k in places]

    ready: list[int] = []
    ready_bytes = 0
    for group in several:
        size = int((more[group] + BYTES.length).sum())
        if size >= 2 * ARRAY_BYTES:
            search(group.tolist(), _starts_of_large(data(group), gram))
            continue
        ready += group.tolist()
        ready_bytes += size
        if ready_bytes >= ARRAY_BYTES:
            search(ready, repeated_starts(data(ready), BYTES.length))
            ready, ready_bytes = [], 0
    if ready:
        search(ready, repeated_starts(data(ready), BYTES.length))
    return [np.unique(np.concatenate(o)) if o else np.empty(0, dtype=np.int64) for o in out]


def _searched(some: list[tuple], large: bool = False) -> pa.RecordBatch:
    """Stretches of repeated starts among segments ``(doc_id, text_hash, start, data)``, by one suffix array; a
    ``large`` anchor's by several."""
    parts = [s[3] for s in some]
    starts = _starts_of_large(parts, BYTES.gram) if large else repeated_starts(parts, BYTES.length)
    rows: list[list] = [[], []]
    firsts, mores = [], []
    for (doc_id, text_hash, start, _), found in zip(some, starts, strict=True):
        if len(found):
            cut = np.flatnonzero(np.diff(found) > 1) + 1
            first = found[np.concatenate([[0], cut])]
            firsts.append(first + start)
            mores.append(found[np.concatenate([cut - 1, [len(found) - 1]])] - first)
            rows[0] += [doc_id] * len(first)
            rows[1] += [text_hash] * len(first)
    n = len(rows[0])
    first, more = (np.concatenate(x).astype(np.int32) if x else np.empty(0, np.int32) for x in (firsts, mores))
    zero = pa.array(np.zeros(n, np.int64))
    return pa.RecordBatch.from_arrays([zero, zero, pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(first),
                                       pa.array(more), zero, pa.array(np.ones(n, bool))], schema=_FOUND_ARROW)


def _named(some: list[tuple]) -> pa.RecordBatch:
    """Named strings of segments."""
    inside = [np.arange(len(s[3]) - BYTES.length + 1) for s in some]
    names = [window_names(s[3], i, BYTES.length, BYTES) for s, i in zip(some, inside, strict=True)]
    return _name_batch([s[0] for s in some], [s[1] for s in some], [i + s[2] for s, i in zip(some, inside, strict=True)], names)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "text_hash", "start", "data")]
        for anchor, *rest in zip(*columns, strict=True):
            yield anchor, tuple(rest)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings among segments that come in the order of their anchors.

    Whole anchors are gathered up to ``ARRAY_BYTES`` and searched with one suffix array. An anchor with more is
    searched by itself. One with more than ``GROUP_BYTES`` has its windows named instead, part by part.
    """
    ready: list[tuple] = []  # whole anchors
    group: list[tuple] = []  # segments of the anchor at hand
    ready_bytes = group_bytes = 0
    of = None
    named = False  # part of the anchor at hand has been named

    def whole() -> Iterator[pa.RecordBatch]:
        """Ends the anchor at hand."""
        nonlocal ready, ready_bytes
        if named:
            yield _named(group)
        elif group_bytes >= 2 * ARRAY_BYTES:
            yield _searched(group, large=True)
        else:
            ready += group
            ready_bytes += group_bytes
            if ready_bytes >= ARRAY_BYTES:
                yield _searched(ready)
                ready, ready_bytes = [], 0

    for anchor, segment in _segments(batches):
        if anchor != of:
            yield from whole()
            group, group_bytes, named, of = [], 0, False, anchor
        group.append(segment)
        group_bytes += len(segment[3])
        if group_bytes >= (2 * ARRAY_BYTES if named else GROUP_BYTES):
            for k in range(0, len(group), NAMED):
                yield _named(group[k : k + NAMED])
            group, group_bytes, named = [], 0, True
    yield from whole()
    if ready:
        yield _searched(ready)


def _name_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _named([s for _, s in _segments([batch])])


def repeated_bytes(texts: DataFrame) -> DataFrame:
    """Starts of repeated 400-byte strings of ``keyed`` texts: ``doc_id, text_hash, start, more``.

    Equal spans are settled as a whole. The different spans over one anchor meet in one
    task, where a suffix array, its Burrows-Wheeler transform and the expansion of
    intervals up to 400 bytes tell which strings are repeated; each stretch of them is one row. Spans of hot anchors, which
    may be in every document, do not meet: their strings are named and counted.
    """
    settled, open_ = candidates(texts, BYTES, "bytes")
    cut = stored(_joined(texts, open_, "inner", "start", "more", "anchor", "hot").mapInArrow(_cut, _SEGMENTS), "segments")
    cold = cut.where("not hot").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_expand, _FOUND)
    found = stored(cold.unionByName(cut.where("hot").mapInArrow(_name_segments, _FOUND)), "found-strings")
    return settled.unionByName(_repeated_names(found))


def covered(n: int, spans: list[dict] | None, length: int) -> np.ndarray:
    """Mask of the units that lie in a window of the spans."""
    edges = np.zeros(n + 1, dtype=np.int64)
    if spans:
        start = np.array([s["start"] for s in spans], dtype=np.int64)
        more = np.array([s["more"] for s in spans], dtype=np.int64)
        np.add.at(edges, start, 1)
        np.add.at(edges, start + more + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _rest_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, gone, kept = [], [], []
        for r in batch.to_pylist():
            words = r["text"].split()
            out = covered(len(words), r["spans"], WORDS.length)
            counts.append(len(words))
            gone.append(int(out.sum()))
            kept.append(b" ".join(w for w, x in zip(words, out.tolist(), strict=True) if not x))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _rest_of_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, gone, runs, kept = [], [], [], []
        for r in batch.to_pylist():
            data = np.frombuffer(r["text"], dtype=np.uint8)
            out = covered(len(data), r["spans"], BYTES.length)
            counts.append(len(data))
            gone.append(int(out.sum()))
            runs.append(int(np.count_nonzero(out[1:] & ~out[:-1]) + (len(out) > 0 and out[0])))
            kept.append(data[~out].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in (counts, gone, runs)], pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (the words left, joined by spaces).

    A word goes if a window of 35 words that covers it also starts anywhere else, in the
    same document or another; windows are judged on the input. A null text has no words; repeated rows are
    documents of their own, so their windows are repeated; ids are whole numbers or null; an empty table
    gives an empty result; other columns are not read.
    """
    texts = keyed(docs, doc_id, text)
    return _joined(texts, repeated_words(texts), "left", "start", "more").mapInArrow(
        _rest_of_words, "doc_id long, n_words long, n_removed long, kept binary"
    )


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left).

    A byte goes if a string of 400 bytes that covers it also starts anywhere else, in the
    same document or another; strings are judged on the input and may end inside a character. A null text has
    no bytes; repeated rows are documents of their own; ids are whole numbers or null; an empty table
    gives an empty result; other columns are not read.
    """
    texts = keyed(docs, doc_id, text)
    return _joined(texts, repeated_bytes(texts), "left", "start", "more").mapInArrow(
        _rest_of_bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
