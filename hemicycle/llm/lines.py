"""Removal of lines that many documents hold, found by two Bloom filters.

Every task notes the hashes of its long lines in two filters, one for hashes seen once, one
for those seen twice; filters of tasks are merged word by word of bits, where a bit that two of
them have seen once is seen twice. A line whose bits are all seen twice is suspected. Only
suspected lines are shuffled: their whole keys are counted, and the document that keeps the
line is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .anchors import by_document, keyed, same_document

#: White space that is stripped from a line for its key.
STRIPPED = b" \t\n\x0b\x0c\r"
#: Code points of a key and documents that hold it, at least.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Bytes of text per word of 64 filter bits: some four long lines a word.
BYTES_A_WORD = 256
#: Filter words of a segment, the unit in which filters are merged.
SEGMENT = 1 << 14
#: Hashes that a task gathers before it notes them.
FLUSH = 1 << 20
#: A key of more documents than this does not meet in one task; rises with the table, so that
#: at most MAX_HOT keys do so.
HOT_ROWS, MAX_HOT = 4096, 100_000
#: Filter words (16 bytes each) that are sent to every task; beyond that hashes are joined with the words.
SENT_WORDS = 1 << 21


def long_keys(text: bytes) -> dict[bytes, list[int]]:
    """Keys of at least ``LEAST_CHARS`` code points with the numbers of their lines.

    ``bytes.lower`` and ``bytes.strip`` know exactly the ASCII letters and white space.
    """
    found: dict[bytes, list[int]] = {}
    for k, line in enumerate(text.split(b"\n")):
        if len(line) < LEAST_CHARS:
            continue
        key = line.strip(STRIPPED).lower()
        if len(key) >= LEAST_CHARS and (key.isascii() or len(key.decode()) >= LEAST_CHARS):
            found.setdefault(key, []).append(k)
    return found


def _hashed(keys: dict[bytes, list[int]]) -> list[int]:
    return [xxhash.xxh64_intdigest(k) for k in keys]


def _words_and_masks(hashes: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter word of each hash and its three bits there."""
    one = np.uint64(1)
    masks = np.zeros(len(hashes), dtype=np.uint64)
    for shift in (0, 6, 12):
        masks |= one << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return ((hashes >> np.uint64(18)) & np.uint64(n_words - 1)).astype(np.int64), masks


def _noted(hashes: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the filters that hashes touch, with the bits seen once or more and those seen twice or more."""
    distinct, times = np.unique(hashes, return_counts=True)
    words, masks = _words_and_masks(distinct, n_words)
    order = np.argsort(words, kind="stable")
    return _merged(words[order], masks[order], np.where(times > 1, masks, np.uint64(0))[order])


def _merged(words: np.ndarray, once: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal ``words`` (in order) as one: bits that two rows have seen once count as seen twice."""
    if not len(words):
        return words, once, twice
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    sizes = np.diff(np.append(first, len(words)))
    all_once, all_twice = once[first].copy(), twice[first].copy()
    for k in range(1, int(sizes.max())):
        has = np.flatnonzero(sizes > k)
        row = first[has] + k
        all_twice[has] |= twice[row] | (all_once[has] & once[row])
        all_once[has] |= once[row]
    return words[first], all_once, all_twice


_NOTES = pa.schema([("segment", pa.int64()), ("words", pa.binary()), ("once", pa.binary()), ("twice", pa.binary())])


def seen_twice(texts: DataFrame, n_words: int) -> DataFrame:
    """``word, bits``: words of the twice-seen filter that are not empty, over the long lines of ``keyed`` texts.

    A task sends one row per segment of the filter and ``FLUSH`` hashes; what a segment
    receives follows from its share of the hashes, for a key's copies in a task are one.
    """
    size = min(SEGMENT, n_words)

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []

        def rows() -> pa.RecordBatch:
            words, once, twice = _noted(np.array(held, dtype=np.uint64), n_words)
            segments, first = np.unique(words // size, return_index=True)
            cut = [*first.tolist(), len(words)]
            spans = list(zip(cut[:-1], cut[1:], strict=True))
            return pa.RecordBatch.from_arrays([
                pa.array(segments, pa.int64()), pa.array([(words[a:b] % size).astype("<u2").tobytes() for a, b in spans], pa.binary()),
                pa.array([once[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([twice[a:b].tobytes() for a, b in spans], pa.binary())], schema=_NOTES)

        for batch in batches:
            for text in batch.column(0):
                held += _hashed(long_keys(text.as_py()))
                if len(held) >= FLUSH:
                    yield rows()
                    held = []
        if held:
            yield rows()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Dense filters of one segment; sparse notes are folded in as they come.
        once, twice, segment = np.zeros(size, np.uint64), np.zeros(size, np.uint64), 0
        for batch in batches:
            for row in batch.to_pylist():
                segment = row["segment"]
                at = np.frombuffer(row["words"], dtype="<u2")
                new = np.frombuffer(row["once"], dtype="<u8")
                twice[at] |= np.frombuffer(row["twice"], dtype="<u8") | (once[at] & new)
                once[at] |= new
        used = np.flatnonzero(twice)
        yield pa.RecordBatch.from_arrays([pa.array(used + segment * size), pa.array(twice[used].view(np.int64))], names=["word", "bits"])

    notes = texts.select("text").mapInArrow(note, "segment long, words binary, once binary, twice binary")
    return notes.groupBy("segment").applyInArrow(merge, "word long, bits long")


_HELD = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.binary()), ("lines", pa.list_(pa.int32()))])
_HELD_SQL = "doc_id long, text_hash long, key binary, lines array<int>"


def _held(batch: pa.RecordBatch, found: list[tuple[int, bytes, list[int]]]) -> pa.RecordBatch:
    of = pa.array([f[0] for f in found], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(of), batch.column("text_hash").take(of), pa.array([f[1] for f in found], pa.binary()),
         pa.array([f[2] for f in found], pa.list_(pa.int32()))], schema=_HELD)


def suspected_lines(texts: DataFrame, n_words: int, sent_words: int = SENT_WORDS) -> DataFrame:
    """``doc_id, text_hash, key, lines``: long keys whose bits are all seen twice, once per document.

    Up to ``sent_words`` words of the filter are sent to every task, which then looks its own
    lines up. A larger filter stays in the shared folder: hashes are joined with its words, and
    what is suspected goes back to the documents.
    """
    spark = texts.sparkSession
    words = stored(seen_twice(texts, n_words), "seen-twice")
    if words.count() <= sent_words:
        table = words.toArrow()
        at, bits = table["word"].to_numpy(), table["bits"].to_numpy().view(np.uint64)
        order = np.argsort(at)
        sent = spark.sparkContext.broadcast((at[order], bits[order]))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, bits = sent.value
            for batch in batches:
                keys = [long_keys(t.as_py()) for t in batch.column("text")]
                hashes = np.array([h for k in keys for h in _hashed(k)], dtype=np.uint64)
                word, mask = _words_and_masks(hashes, n_words)
                place = np.minimum(np.searchsorted(at, word), max(len(at) - 1, 0))
                twice = (at[place] == word) & (bits[place] & mask == mask) if len(at) else np.zeros(len(word), bool)
                rows = [(k, key, lines) for k, some in enumerate(keys) for key, lines in some.items()]
                yield _held(batch, [rows[i] for i in np.flatnonzero(twice)])

        return texts.mapInArrow(look_up, _HELD_SQL)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_hashed(long_keys(t.as_py())) for t in batch.column("text")]
            of = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]), pa.int64())
            flat = np.array([h for k in keys for h in k], dtype=np.uint64)
            word, mask = _words_and_masks(flat, n_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(of), batch.column("text_hash").take(of), pa.array(flat.view(np.int64)),
                 pa.array(word), pa.array(mask.view(np.int64))], names=["doc_id", "text_hash", "hash", "word", "mask"])

    marks = texts.mapInArrow(hashed, "doc_id long, text_hash long, hash long, word long, mask long")
    met = marks.join(words, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    both = texts.join(by_document(met, "hash"), same_document()).select("doc_id", "text_hash", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, (text, spans) in enumerate(zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True)):
                wanted = {s["hash"] & (1 << 64) - 1 for s in spans}
                found = long_keys(text.as_py())
                rows += [(k, key, lines) for h, (key, lines) in zip(_hashed(found), found.items(), strict=True) if h in wanted]
            yield _held(batch, rows)

    return both.mapInArrow(cut, _HELD_SQL)


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, gone, kept = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            lines = text.as_py().split(b"\n")
            drop = {n for s in spans or () for n in s["lines"]}
            counts.append(len(lines))
            gone.append(len(drop))
            kept.append(b"\n".join(x for k, x in enumerate(lines) if k not in drop) if drop else text.as_py())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_lines", "n_dropped", "kept"],
        )


def drop_common_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_docs: int = LEAST_DOCS,
                      sent_words: int = SENT_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept`` (the lines left, joined by line feeds, UTF-8 bytes).

    Lines are told apart by their key: white space stripped, A to Z in lower case. Lines whose
    key has ``LEAST_CHARS`` code points or more and stands in ``least_docs`` documents or more
    (two at least) stay in the document with the largest id that holds the key, and go from all others.

    A null or empty text is one empty line. Rows that repeat an id are documents of their
    own; if theirs is the largest id all of them keep the line. Null ids count as smallest. Ids are
    whole numbers; an empty table gives an empty result; other columns are not read. Texts are told apart by id and a 64-bit
    hash; keys are compared whole.
    """
    if least_docs < 2:
        raise ValueError("the filters find keys of two documents or more")
    texts = keyed(docs, doc_id, text)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_words = 1 << max(4, int(size // BYTES_A_WORD).bit_length())
    held = stored(suspected_lines(texts, n_words, sent_words), "suspected-lines")
    counted = held.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= least_docs)
    counted = stored(counted, "common-lines")
    # Keys of very many documents, MAX_HOT at most, are sent to every task by their digest; their rows do not meet.
    limit = max(HOT_ROWS, -(-held.count() // MAX_HOT))
    hot = counted.where(F.col("n") > limit).select(F.sha2("key", 256).alias("_digest"), F.col("keeper").alias("_keeper"), F.lit(True).alias("_hot"))
    dealt = held.withColumn("_digest", F.sha2("key", 256)).join(F.broadcast(hot), "_digest", "left").drop("_digest")
    rare = dealt.where("_hot is null").drop("_hot", "_keeper").join(counted.drop("n"), "key")
    often = dealt.where("_hot").select("key", "doc_id", "text_hash", "lines", F.col("_keeper").alias("keeper"))
    gone = rare.unionByName(often).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    both = texts.join(by_document(gone, "lines"), same_document(), "left").select("doc_id", "text_hash", "text", "spans")
    return both.mapInArrow(_rest, "doc_id long, n_lines long, n_dropped long, kept binary")
