"""Near-duplicates by SimHash fingerprints and an inverted index over byte positions."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import text_of, whole_rows
from .components import components

#: Words of a shingle and seed of its XXH64.
SHINGLE, SEED = 3, 42
#: Two fingerprints link at this many differing bits or fewer; they then share at least this many of 8 bytes.
MAX_BITS = 2
LEAST_BYTES = 8 - MAX_BITS
#: A posting list of this many fingerprints or fewer is compared member by member.
SHORT_LIST = 32
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def simhash(data: bytes | None) -> int:
    """64-bit fingerprint of a UTF-8 text as a signed number; zero without words."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(SHINGLE, len(words))
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), CHUNK):
        part = hashes[k : k + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text column: words are split from its bytes, ASCII letters lower-cased.

    ``bytes.split`` and ``bytes.lower`` know exactly the ASCII separators and letters.
    """

    def prints(batch: pd.Series) -> pd.Series:
        return pd.Series([simhash(t) for t in batch], dtype="int64")

    return F.pandas_udf(prints, "long")(text.cast("binary"))


#: Bits of the bytes at each set of positions that a list shares.
MASKS = [sum(0xFF << (8 * k) for k in places) for places in combinations(range(8), LEAST_BYTES)]


def _signed(n: int) -> Column:
    return F.lit(n - (1 << 64) if n >> 63 else n).cast("long")


def posting_lists(prints: DataFrame) -> DataFrame:
    """``places, bytes, members``: fingerprints (distinct ``print``) that share six of their eight bytes.

    The index is over positions and values of bytes. Counting matches per pair from single
    bytes would meet each pair of the table in some list. Two fingerprints that link share
    at least six positional bytes, so the lists are kept per six positions at once: whoever
    meets in a list has reached the guaranteed count. A list holds the two remaining bytes
    only, 65,536 members at most. Lists of one member are dropped.
    """
    keys = F.array(*[
        F.struct(F.lit(i).cast("byte").alias("places"), F.col("print").bitwiseAND(_signed(m)).alias("bytes"))
        for i, m in enumerate(MASKS)
    ])
    postings = prints.select("print", F.explode(keys).alias("key")).select("key.*", "print")
    lists = postings.groupBy("places", "bytes").agg(F.collect_list("print").alias("members"))
    return lists.where(F.size("members") > 1)


def links(prints: DataFrame) -> DataFrame:
    """Edges ``a, b`` between distinct ``print`` values that connect what links.

    Short lists give each pair within ``MAX_BITS`` bits. In a long list each member names
    the values at most one bit away from it within the list's two free bytes; those who
    name the same value are within two bits of each other, and any two within two bits name
    a value in common, so linking them to the smallest of them connects the same members
    with a row per member and value, never a row per pair.
    """
    lists = stored(posting_lists(prints), "postings")
    short = lists.where(F.size("members") <= SHORT_LIST).select(
        F.explode(F.transform("members", lambda x: F.struct(x.alias("a"), F.col("members").alias("others")))).alias("m")
    )
    near = F.filter("m.others", lambda y: (y < F.col("m.a")) & (F.bit_count(y.bitwiseXOR(F.col("m.a"))) <= MAX_BITS))
    short = short.select(F.col("m.a").alias("a"), F.explode(near).alias("b"))
    long = lists.where(F.size("members") > SHORT_LIST)
    long = long.select("places", "bytes", F.explode("members").alias("print"))
    # Nothing, or one bit outside the six shared bytes.
    flips = F.array(*[F.array(*[_signed(f) for f in [0, *[1 << k for k in range(64) if not m >> k & 1]]]) for m in MASKS])
    named = long.select("places", "print", F.explode(F.get(flips, F.col("places").cast("int"))).alias("flip"))
    named = named.select("places", "print", F.col("print").bitwiseXOR(F.col("flip")).alias("middle"))
    least = named.groupBy("places", "middle").agg(F.min("print").alias("b"), F.count("*").alias("n")).where("n > 1")
    star = named.join(least, ["places", "middle"]).where("print <> b").select(F.col("print").alias("a"), "b")
    return short.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest id reachable over
    links, the document's own included. A text without words (null, empty, only white
    space) has fingerprint zero and links like any other. Null ids are no component's
    smallest unless it has no other; repeated rows are documents of their own; an empty
    table gives an empty result. Other columns are not read.
    """
    rows = stored(docs.select(docs[doc_id].alias("doc_id"), fingerprint(text_of(text)).alias("print")), "prints")
    return _with_components(rows).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                                         "component_id")


def _with_components(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, print``) with ``component_id``."""
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least_id")), "distinct-prints")
    roots = components(links(prints.select("print")))
    classes = prints.join(roots, F.col("print") == F.col("node"), "left")
    classes = classes.select("print", "least_id", F.coalesce("root", "print").alias("class"))
    least = classes.groupBy("class").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "class").select("print", "component_id")
    return rows.join(named, "print")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, one of each component: that with the smallest id.

    Of rows that repeat this id one stays, the one with the smallest hash of its text.
    Null ids, empty texts and ties as in :func:`near_duplicates`; a component without any id
    keeps one row per fingerprint.
    """
    content = F.xxhash64(text_of(text))
    rows = docs.select(docs[doc_id].alias("doc_id"), content.alias("content"), fingerprint(text_of(text)).alias("print"))
    named = _with_components(stored(rows, "prints"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "content")
    stay = named.groupBy("component_id", F.col("component_id").isNull().alias("_nameless"),
                         F.when(F.col("component_id").isNull(), F.col("print")).alias("_print"))
    stay = stay.agg(F.min(first).alias("first")).select(F.col("first.doc_id").alias("of"), F.col("first.content").alias("is"))
    whole = whole_rows(docs, doc_id=docs[doc_id], content=content)
    kept = whole.join(stay, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("content") == F.col("is")))
    one = Window.partitionBy("of", "is").orderBy("content")
    return kept.withColumn("place", F.row_number().over(one)).where("place = 1").select("row.*")
