"""Token counts from flat token files by a scan for separators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .vocabulary import END_OF_DOCUMENT, encoder, shipped

#: Ids of a block; two bytes each, little-endian.
BLOCK = 1 << 16
#: Blocks that one window scans; the sums of such stretches are scanned in turn.
STRETCH = 1 << 10
#: Document ids of a row of the list of documents.
NAMES = 1 << 12

_FILES = "file long, block long, ids binary, first long, names array<long>"


def write_token_files(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents as flat token files in the shared folder.

    A file is what one task has read: ids of all its documents, each followed by the
    separator, in blocks of ``BLOCK`` ids that take no notice of documents. Rows are
    ``file, block, ids``, or, for the list of documents in order, ``file, first, names``.
    The ids are below 65,536, so two bytes hold one. The string of the separator in a text is
    ordinary text here, so a separator is always the end of a document.
    """
    ranks = shipped(docs.sparkSession, vocabulary)
    arrow = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("ids", pa.binary()), ("first", pa.int64()),
                       ("names", pa.list_(pa.int64()))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value)
        file = TaskContext.get().partitionId()
        parts: list[np.ndarray] = []
        held, block, n_docs = 0, 0, 0
        names: list[int | None] = []

        def row(block: int | None, ids: bytes | None, first: int | None, names: list | None) -> pa.RecordBatch:
            values = ([file], [block], [ids], [first], [names])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(value.as_py()).astype("<u2")
                parts += [ids, np.array([END_OF_DOCUMENT], dtype="<u2")]
                held += len(ids) + 1
                names.append(name)
                if held >= BLOCK:
                    flat = np.concatenate(parts)
                    whole = held // BLOCK * BLOCK
                    for at in range(0, whole, BLOCK):
                        yield row(block, flat[at : at + BLOCK].tobytes(), None, None)
                        block += 1
                    parts, held = [flat[whole:]], held - whole
                if len(names) == NAMES:
                    yield row(None, None, n_docs, names)
                    n_docs, names = n_docs + len(names), []
        if held:
            yield row(block, np.concatenate(parts).tobytes(), None, None)
        if names:
            yield row(None, None, n_docs, names)

    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    path = scratch_path(docs.sparkSession, "token-files")
    texts.mapInArrow(write, _FILES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_FILES).parquet(path)


def read_token_files(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """``path, file, block, ids`` of token files below a folder; a file is one cell, so under 2 GB."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    size = 2 * block
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.octet_length("content") - 1) / size))
    cut = files.where(F.octet_length("content") > 0).select("path", "content", F.explode(blocks).alias("block"))
    ids = F.substring("content", F.col("block").cast("int") * size + 1, F.lit(size))
    return cut.select("path", F.xxhash64("path").alias("file"), "block", ids.alias("ids"))


def separator_scan(blocks: DataFrame, separator: int = END_OF_DOCUMENT) -> DataFrame:
    """One row per document of ``file, block, ids``: ``file, position, n_tokens, closed``.

    Every block is searched by itself for separators; it reports the ids ahead of the
    first, the lengths between, and the ids after the last. A scan of these reports per
    file numbers the documents and adds what earlier blocks hold of a block's first one: it runs
    over stretches of ``STRETCH`` blocks and over the sums of the stretches, so a file of
    any length takes many tasks. ``position`` counts documents of a file from 0;
    ``n_tokens`` leaves the separator out; two separators in a row enclose an empty
    document; what follows the last separator of a file is a document that is not
    ``closed``. No blocks give no rows. Blocks are numbered from 0 without gaps.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails, inner, counts = [], [], [], []
            for value in batch.column(2):
                ids = np.frombuffer(value.as_buffer() or b"", dtype="<u2") if value.is_valid else np.empty(0, "<u2")
                at = np.flatnonzero(ids == separator)
                counts.append(len(at))
                heads.append(int(at[0]) if len(at) else len(ids))
                tails.append(len(ids) - int(at[-1]) - 1 if len(at) else len(ids))
                inner.append((np.diff(at) - 1).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(heads, pa.int64()),
                 pa.array(tails, pa.int64()), pa.array(inner, pa.list_(pa.int64()))],
                names=["file", "block", "n_found", "head", "tail", "inner"],
            )

    found = blocks.select(F.col("file").cast("long"), F.col("block").cast("long"), "ids").mapInArrow(
        search, "file long, block long, n_found long, head long, tail long, inner array<long>"
    )
    found = found.withColumn("stretch", F.floor(F.col("block") / STRETCH))
    # Ids since the last separator: those of the blocks after the last block with one, and its tail.
    piece = Window.partitionBy("file", "stretch").orderBy("block")
    ahead = piece.rowsBetween(Window.unboundedPreceding, -1)
    upto = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = found.select(
        "*",
        F.coalesce(F.sum("n_found").over(ahead), F.lit(0)).alias("docs_ahead"),
        # Blocks with a separator start a new run; a run's first tail and later whole blocks add up.
        F.sum(F.when(F.col("n_found") > 0, 1).otherwise(0)).over(upto).alias("run"),
    )
    in_run = Window.partitionBy("file", "stretch", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    scanned = scanned.withColumn("open_ids", F.sum("tail").over(in_run))
    carried = piece
    scanned = scanned.withColumn("carry", F.coalesce(F.lag("open_ids").over(carried), F.lit(0)))
    scanned = scanned.withColumn("runs_ahead", F.coalesce(F.lag("run").over(carried), F.lit(0)))
    sums = scanned.groupBy("file", "stretch").agg(
        F.sum("n_found").alias("n_found"), F.max("run").alias("runs"), F.max_by("open_ids", "block").alias("open_ids")
    )
    whole = Window.partitionBy("file").orderBy("stretch")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("stretch_docs", F.coalesce(F.sum("n_found").over(before), F.lit(0)))
    sums = sums.withColumn("run2", F.sum(F.when(F.col("runs") > 0, 1).otherwise(0)).over(
        whole.rowsBetween(Window.unboundedPreceding, 0)))
    in_run2 = Window.partitionBy("file", "run2").orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("open_all", F.sum("open_ids").over(in_run2))
    sums = sums.withColumn("stretch_carry", F.coalesce(F.lag("open_all").over(whole), F.lit(0)))
    last = Window.partitionBy("file")
    ends = sums.withColumn("last", F.max("stretch").over(last)).where("stretch = last")
    ends = ends.where("open_all > 0").select("file", (F.col("stretch_docs") + F.col("n_found")).alias("position"),
                                             F.col("open_all").alias("n_tokens"), F.lit(False).alias("closed"))
    joined = scanned.where("n_found > 0").join(sums.select("file", "stretch", "stretch_docs", "stretch_carry"),
                                               ["file", "stretch"])
    # The carry of earlier stretches reaches a block only if no block of its own stretch has cut it off.
    first = F.col("head") + F.col("carry") + F.when(F.col("runs_ahead") == 0, F.col("stretch_carry")).otherwise(0)
    lengths = F.concat(F.array(first), F.col("inner"))
    docs = joined.select("file", (F.col("stretch_docs") + F.col("docs_ahead")).alias("base"), F.posexplode(lengths))
    docs = docs.select("file", (F.col("base") + F.col("pos")).alias("position"), F.col("col").alias("n_tokens"),
                       F.lit(True).alias("closed"))
    return docs.unionByName(ends)


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` of every document, from the token files that hold them.

    A null or empty text has no tokens; rows that repeat an id are documents of their own;
    null ids stay null; an empty table gives an empty result; other columns are not read.
    """
    files = write_token_files(docs, vocabulary, doc_id, text)
    counts = separator_scan(files.where("block is not null")).select("file", "position", "n_tokens")
    names = files.where("names is not null").select("file", "first", F.posexplode("names"))
    names = names.select("file", (F.col("first") + F.col("pos")).alias("position"), F.col("col").alias("doc_id"))
    return names.join(counts, ["file", "position"]).select("doc_id", "n_tokens")
