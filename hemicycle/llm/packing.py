"""Packing documents into sequences of bounded length, online and in bounded space."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .vocabulary import ADDED, encoder, shipped

#: Sequence length, open windows of a task, and the smallest part worth cutting off a piece.
SIZE, OPEN, LEAST_CUT = 2048, 64, 32
#: Last id of every document.
END = 1
#: Tasks whose leftover windows are merged by one task.
MERGE_TASKS = 1024
#: Rows of an output batch.
BATCH = 8192


class Piece(NamedTuple):
    """``ids`` of a document from ``start`` on; the document has ``doc_tokens`` ids."""

    doc_id: object
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:n]), self._replace(start=self.start + n, ids=self.ids[n:])


class Packer:
    """Open windows of one task. ``full`` collects windows (lists of pieces) that are done.

    A piece goes into the open window whose gap it fills best. If none has room and no
    further window may open, the fullest window is emitted; a gap of ``least_cut`` or more
    is filled first with the head of the piece.
    """

    def __init__(self, size: int = SIZE, n_open: int = OPEN, least_cut: int = LEAST_CUT):
        self.size, self.n_open, self.least_cut = size, n_open, least_cut
        self.gaps: list[tuple[int, int]] = []  # (gap, window), smallest gap first
        self.windows: dict[int, list[Piece]] = {}
        self.opened = 0
        self.full: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.size:
            head, piece = piece.cut(self.size)
            self.full.append([head])
        while len(piece.ids):
            n = len(piece.ids)
            at = bisect_left(self.gaps, (n, -1))
            if at < len(self.gaps):
                gap, window = self.gaps.pop(at)
                self.windows[window].append(piece)
                self._keep(gap - n, window)
                return
            if len(self.gaps) < self.n_open:
                self.windows[self.opened] = [piece]
                self._keep(self.size - n, self.opened)
                self.opened += 1
                return
            gap, window = self.gaps.pop(0)
            if gap >= self.least_cut:
                head, piece = piece.cut(gap)
                self.windows[window].append(head)
            self.full.append(self.windows.pop(window))

    def _keep(self, gap: int, window: int) -> None:
        if gap:
            insort(self.gaps, (gap, window))
        else:
            self.full.append(self.windows.pop(window))

    def finish(self) -> list[Piece]:
        """Merge the open windows: the fullest take pieces, cut where they must be, from the
        emptiest. All but one are then full; the pieces of that one are returned."""
        order = [(gap, self.windows[w]) for gap, w in self.gaps]
        self.gaps, self.windows = [], {}
        while len(order) > 1:
            gap, pieces = order.pop(0)
            while gap and order:
                room, giver = order.pop()
                piece = giver.pop()
                if len(piece.ids) > gap:
                    head, rest = piece.cut(gap)
                    giver.append(rest)
                    piece = head
                pieces.append(piece)
                gap -= len(piece.ids)
                if giver:
                    order.append((room + len(piece.ids), giver))
            if gap:
                return pieces
            self.full.append(pieces)
        return order[0][1] if order else []


def _rows(windows: list[list[Piece]], first: int, with_ids: bool) -> Iterator[tuple]:
    for k, pieces in enumerate(windows):
        offset = 0
        for p in pieces:
            data = p.ids.astype("<u4").tobytes()
            yield (p.doc_id, p.start, len(p.ids), zlib.crc32(data), p.doc_tokens, first + k, offset,
                   data if with_ids else None)
            offset += len(p.ids)


def _schema(doc_id: T.DataType) -> T.StructType:
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return T.StructType([T.StructField("doc_id", doc_id), *[T.StructField(c, T.LongType()) for c in longs],
                         T.StructField("ids", T.BinaryType()), T.StructField("left_over", T.BooleanType())])


def _packed(pieces: Iterator[Piece], level: int, with_ids: bool, packer: Packer) -> Iterator[list[tuple]]:
    """Rows of the windows of one task. A sequence's number holds the level, the task and a count."""
    number = (level << 56) | (TaskContext.get().partitionId() << 32)
    rows: list[tuple] = []
    for piece in pieces:
        packer.add(piece)
        if packer.full:
            rows += [(*r, False) for r in _rows(packer.full, number, with_ids)]
            number += len(packer.full)
            packer.full.clear()
        if len(rows) >= BATCH:
            yield rows
            rows = []
    last = packer.finish()
    rows += [(*r, False) for r in _rows(packer.full, number, with_ids)]
    # The ids of the last window go along: another task may cut its pieces again.
    rows += [(*r, True) for r in _rows([last], number + len(packer.full), True)]
    yield rows


def _batches(rows: Iterator[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for some in rows:
        if some:
            columns = list(zip(*some, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
         n_open: int = OPEN, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    Every task tokenises its documents as it reads them, adds the last id, and keeps at most
    ``n_open`` windows. What is left in a task at its end is merged into full sequences and
    one window; those windows, one per task, are merged by ``MERGE_TASKS`` at a time. Texts
    are not shuffled. So one sequence per ``MERGE_TASKS`` tasks has a gap of any size, all
    others one below ``LEAST_CUT``.

    ``vocabulary`` is the path of a rank file; the strings of ``ADDED`` in a text are their own
    tokens. A null or empty text is the last id alone;
    rows that repeat an id are documents of their own; null ids stay null; an empty table
    gives an empty result; other columns are not read. ``ids`` (little-endian, four bytes each) is null
    unless ``with_ids``.
    """
    schema = _schema(docs.schema[doc_id].dataType)
    shape = docs.select(F.col(doc_id).alias("doc_id")).limit(0).toArrow().schema.field("doc_id").type
    longs = [f.name for f in schema if isinstance(f.dataType, T.LongType) and f.name != "doc_id"]
    arrow = pa.schema([("doc_id", shape), *[(c, pa.int64()) for c in longs], ("ids", pa.binary()), ("left_over", pa.bool_())])
    ranks = shipped(docs.sparkSession, vocabulary)

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value, ADDED)

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.append(encode(value.as_py()), np.uint32(END))
                    yield Piece(name, 0, ids, len(ids))

        yield from _batches(_packed(pieces(), 0, with_ids, Packer(size, n_open)), arrow)

    def of_left_overs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield Piece(row["doc_id"], row["start"], np.frombuffer(row["ids"], dtype="<u4"), row["doc_tokens"])

        yield from _batches(_packed(pieces(), 1, with_ids, Packer(size, n_open)), arrow)

    texts = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    first = stored(texts.mapInArrow(of_documents, schema), "packed")
    left = first.where("left_over")
    n = left.select("sequence_id").distinct().count()
    group = F.floor(F.shiftright("sequence_id", 32) / MERGE_TASKS)
    left = left.select("doc_id", "start", "ids", "doc_tokens", group.alias("group"))
    merged = left.repartition(-(-max(n, 1) // MERGE_TASKS), "group").drop("group").mapInArrow(of_left_overs, schema)
    out = first.where("not left_over").unionByName(merged).drop("left_over")
    return out if with_ids else out.withColumn("ids", F.lit(None).cast("binary"))
