"""Periodic runs of words by recompression: a run-length grammar answers how far two places agree.

A word sequence is compressed by turns: blocks of one symbol become a symbol, then pairs of
symbols from two disjoint sets become a symbol, until one is left. Equal stretches of the
sequence are parsed alike but for a few symbols at their ends, so the common extension of two
places climbs the levels while both stand at a border and comes down where symbols differ.
Runs are looked for on harmonic grids: a run of period q and four periods holds four
neighbouring multiples of q, and these hold the same word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: A run has at least this many words and periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Places of harmonic grids that are compared at once.
GRID = 1 << 21
#: Ways of dealing symbols to two sides that are tried; the one with most pairs is taken.
DEALS = 2


class Run(NamedTuple):
    start: int
    length: int
    period: int


class Level(NamedTuple):
    """Symbols of a level and where they start; one more start at the end. ``blocks``: made by block compression."""

    symbols: list[int]
    starts: list[int]
    blocks: bool


def _numbered(keys: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """Equal keys get equal numbers from ``first`` on; the next free number."""
    distinct, numbers = np.unique(keys, return_inverse=True)
    return numbers + first, first + len(distinct)


def _blocks(symbols: np.ndarray, starts: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Maximal blocks of two or more equal symbols become symbols named by symbol and count."""
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    counts = np.diff(np.append(first, len(symbols)))
    out = symbols[first].copy()
    long = counts > 1
    if long.any():
        out[long], free = _numbered(out[long] * (len(symbols) + 1) + counts[long], free)
    return out, starts[first], free


def _pairs(symbols: np.ndarray, starts: np.ndarray, free: int, turn: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each symbol of the left set that stands before one of the right set is paired with it.

    Neighbours differ, so a dealing by a bit of a hash parts a good share of them.
    """
    best = None
    for deal in range(DEALS):
        hashed = (symbols.astype(np.uint64) + np.uint64(turn * DEALS + deal + 1)) * np.uint64(0x9E3779B97F4A7C15)
        left = ((hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 0
        for side in (left, ~left):
            meets = side[:-1] & ~side[1:]
            if best is None or np.count_nonzero(meets) > np.count_nonzero(best):
                best = meets
    at = np.flatnonzero(best)
    out = symbols.copy()
    if len(at):
        out[at], free = _numbered(symbols[at] * free + symbols[at + 1], free)
    stay = np.ones(len(symbols), dtype=bool)
    stay[at + 1] = False
    return out[stay], starts[stay], free


class Grammar:
    """Levels of a sequence of small numbers; the first level is the sequence itself."""

    def __init__(self, sequence: np.ndarray):
        symbols, starts = sequence.astype(np.int64), np.arange(len(sequence), dtype=np.int64)
        self.n = len(sequence)
        self.levels: list[Level] = []
        self._add(symbols, starts, False)
        free, turn = int(symbols.max(initial=-1)) + 1, 0
        while len(symbols) > 1:
            symbols, starts, free = _blocks(symbols, starts, free)
            self._add(symbols, starts, True)
            if len(symbols) > 1:
                symbols, starts, free = _pairs(symbols, starts, free, turn)
                self._add(symbols, starts, False)
            turn += 1

    def _add(self, symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> None:
        self.levels.append(Level(symbols.tolist(), [*starts.tolist(), self.n], blocks))

    def common(self, i: int, j: int) -> int:
        """Length of the longest common stretch from ``i`` and from ``j`` on, ``i`` before ``j``."""
        begin, level, rising = j, 0, True
        while j < self.n:
            here = self.levels[level]
            if rising and level + 1 < len(self.levels):
                above = self.levels[level + 1].starts
                if above[bisect_left(above, i)] == i and above[bisect_left(above, j)] == j:
                    level += 1
                    continue
            a, b = bisect_left(here.starts, i), bisect_left(here.starts, j)
            if here.symbols[a] == here.symbols[b]:
                step = here.starts[a + 1] - i
                if level + 1 < len(self.levels) and self.levels[level + 1].blocks:
                    # Inside blocks of this symbol: as many as both have left.
                    above = self.levels[level + 1].starts
                    ends = above[bisect_left(above, i + 1)] - i, above[bisect_left(above, j + 1)] - j
                    step = min(ends)
                i, j = i + step, j + step
            elif level:
                level, rising = level - 1, False
            else:
                break
        return j - begin


def _grid(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """``(period, place)`` of multiples of a period that may be the first ones of a run.

    The word there also stands one, two and three periods on. From the first multiple in a run on, more than two
    periods of words equal those a period on, so a few of them are compared before the grammar is asked.
    """
    n = len(words)
    first, last = 1, n // LEAST_PERIODS
    while first <= last:
        until, size = first, 0
        while until <= last and (size == 0 or size + n // until + 1 <= GRID):
            # Sizes fall slowly, so a stretch of periods is taken with the size of its first.
            more = max(1, min(last + 1 - until, (GRID - size) // (n // until + 1)))
            size += more * (n // until + 1)
            until += more
        period = np.arange(first, until, dtype=np.int64)
        counts = -(-n // period)
        ends = np.cumsum(counts)
        of = np.repeat(period, counts)
        place = (np.arange(ends[-1]) - np.repeat(ends - counts, counts)) * of
        word = words[place]
        same = word[1:] == word[:-1]
        same[ends[:-1] - 1] = False
        found = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        for probe in (lambda q: 1, lambda q: 2 * q - 1, lambda q: q + 1, lambda q: q // 2, lambda q: q + q // 2, lambda q: q - 1):
            q, at = of[found], place[found] + probe(of[found])
            found = found[words[at] == words[at + q]]
        yield from zip(of[found].tolist(), place[found].tolist(), strict=True)
        first = until


def periodic_runs(words: np.ndarray) -> list[Run]:
    """All runs of a sequence of word numbers, by start, then period."""
    n = len(words)
    found: dict[tuple[int, int], int] = {}
    ahead = behind = None
    period = until = -1
    for q, at in _grid(words):
        if q != period:
            period, until = q, -1
        if at < until:
            continue
        if ahead is None:
            ahead, behind = Grammar(words), Grammar(words[::-1])
        more = ahead.common(at, at + q)
        less = behind.common(n - at - q, n - at)
        until = at + more + 1  # the word there differs from the one a period on
        length = less + more + q
        if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
            # Periods come in rising order, so the first one of a stretch is its smallest.
            found.setdefault((at - less, length), q)
    return sorted((Run(s, n_, q) for (s, n_), q in found.items()), key=lambda r: (r.start, r.period))


def numbered(words: list[bytes]) -> np.ndarray:
    """Small numbers that are equal where words are."""
    known = defaultdict(count().__next__)
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for r in runs:
        gone[r.start + r.period] += 1
        gone[r.start + r.length] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    return [w for w, s in zip(words, stays.tolist(), strict=True) if s]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, found, rest = [], [], []
        for text in batch.column(1):
            words = (text.as_py() or b"").split()
            runs = periodic_runs(numbered(words))
            counts.append(len(words))
            found.append([r._asdict() for r in runs])
            rest.append(b" ".join(collapsed(words, runs) if runs else words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, _RUNS), pa.array(rest, pa.binary())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def document_runs(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``; no shuffle.

    Words stand between ASCII white space and are numbered from 0. ``runs`` has ``start, length, period``
    of every maximal run of ``LEAST_PERIODS`` periods and ``LEAST_WORDS`` words or more, by
    start, then period; ``period`` is the smallest of the run. ``collapsed`` has the words
    that no run holds after its first period, joined by spaces (UTF-8 bytes).

    A null, empty or blank text has no words and no runs; repeated rows are documents of
    their own; ids are whole numbers or null and are handed on; an empty table gives an empty result; other
    columns are not read. A text is handled whole, at some 50 bytes a word while its grammar
    is held.
    """
    content = text_of(text) if isinstance(text, str) else text
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), content.cast("binary").alias("text"))
    kinds = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return rows.mapInArrow(_find, kinds)


def digests(found: DataFrame) -> DataFrame:
    """``document_runs`` in figures: number of runs, the longest one, and hashes of the runs and of what is left."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    # Longest first, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
