"""Codes of vectors by product quantisation; nearest entries by adaptive distance bounds.

A vector is cut into parts, each part has a codebook, and a code names the nearest entry of
each. Between rounds every part of every vector keeps its closest entries in order with a
lower bound of the distance to each and one outer bound for all other entries. After entries
have moved the bounds give way by as much; only entries whose bound is not above the distance
to the entry at hand are measured again, in whole numbers, so ties and close calls are exact.
How many bounds are kept follows from how many were needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bounds kept at first and at least; later as many as all but one in ``SPARE`` parts needed.
BOUNDS, LEAST_BOUNDS, SPARE = 16, 4, 64
#: Scaled components beyond this are cut when they are read.
MOST = float(1 << 40)
#: Rows whose distances are taken at once.
CHUNK = 4096


@dataclass(frozen=True)
class Codebook:
    """``entries[part, entry, position]``, whole numbers; ``moved[part, entry]`` since the bounds were taken."""

    entries: np.ndarray
    moved: np.ndarray


def _down(x: np.ndarray) -> np.ndarray:
    """Single-precision numbers not above ``x``, with room for the rounding of roots."""
    return np.nextafter((x * (1 - 1e-9)).astype(np.float32), np.float32(-np.inf))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x * (1 + 1e-9), np.inf)


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances ``points x entries``, exact: by products of doubles while they are whole, else by integers."""
    width = max(1, points.shape[1])
    most = max(abs(int(a)) for x in (points, entries) for a in (x.min(initial=0), x.max(initial=0)))
    if 4 * width * most * most < 1 << 53:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None]).astype(np.int64)
    out = np.empty((len(points), len(entries)), dtype=np.int64)
    for k, entry in enumerate(entries):
        apart = points - entry
        out[:, k] = (apart * apart).sum(1)
    return out


def _ranked(exact: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` closest entries of each row, by distance."""
    some = np.argpartition(exact, keep - 1, axis=1)[:, :keep] if keep < exact.shape[1] else np.broadcast_to(np.arange(exact.shape[1]), exact.shape)
    # Of entries as far as the last one kept any will do: these are for bounds only.
    return np.take_along_axis(some, np.argsort(np.take_along_axis(exact, some, 1), axis=1, kind="stable"), 1)


class Part:
    """State of one part of some vectors: ``at`` the nearest entry, ``near`` further ones with ``bounds``, ``outer``."""

    def __init__(self, at: np.ndarray, near: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
        self.at, self.near, self.bounds, self.outer = at, near, bounds, outer

    @classmethod
    def fresh(cls, points: np.ndarray, entries: np.ndarray, keep: int) -> Part:
        exact = squares(points, entries)
        keep = min(keep, len(entries) - 1)
        at = exact.argmin(1)
        exact[np.arange(len(points)), at] = np.iinfo(np.int64).max  # the nearest needs no bound
        if keep == 0:
            others = np.full(len(points), np.inf, np.float32) if len(entries) == 1 else _down(np.sqrt(exact.min(1).astype(np.float64)))
            return cls(at, np.zeros((len(points), 0), np.int64), np.zeros((len(points), 0), np.float32), others)
        near = _ranked(exact, keep)
        bounds = _down(np.sqrt(np.take_along_axis(exact, near, 1).astype(np.float64)))
        # All others are at least as far as the last one kept.
        outer = bounds[:, -1].copy() if keep < len(entries) - 1 else np.full(len(points), np.inf, dtype=np.float32)
        return cls(at, near, bounds, outer)

    def shrunk(self, keep: int) -> Part:
        if self.near.shape[1] <= keep:
            return self
        order = np.argsort(self.bounds, axis=1, kind="stable")
        near, bounds = np.take_along_axis(self.near, order, 1), np.take_along_axis(self.bounds, order, 1)
        return Part(self.at, near[:, :keep], bounds[:, :keep], np.minimum(self.outer, bounds[:, keep]))

    def step(self, points: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """Nearest entries after the entries have moved; how many bounds each row needed, one more than kept if all."""
        n, keep = self.near.shape
        if n == 0:
            return np.zeros(0, dtype=np.int64)
        apart = points - entries[self.at]
        own = (apart * apart).sum(1)
        reach = _up(np.sqrt(own.astype(np.float64)))
        bounds = _down(self.bounds.astype(np.float64) - moved[self.near])
        outer = _down(self.outer.astype(np.float64) - moved.max(initial=0.0))
        # In order again: a bound may be lowered to a later one, never raised.
        low = np.minimum.accumulate(np.concatenate([bounds, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        needed = (low <= reach[:, None]).sum(1)
        all_ = needed > keep
        part = np.flatnonzero((needed > 0) & ~all_)
        self.bounds, self.outer = bounds, outer
        at = self.at.copy()
        if len(part):
            deep = int(needed[part].max())
            asked = np.arange(deep)[None] < needed[part][:, None]
            row, place = np.nonzero(asked)
            apart = points[part[row]] - entries[self.near[part[row], place]]
            far = np.full((len(part), deep), np.iinfo(np.int64).max, dtype=np.int64)
            far[row, place] = (apart * apart).sum(1)
            self._settle(part, own[part], far, deep, at)
        if all_.any():
            some = np.flatnonzero(all_)
            new = Part.fresh(points[some], entries, keep)
            at[some] = new.at
            self.near[some, : new.near.shape[1]] = new.near
            self.bounds[some, : new.near.shape[1]] = new.bounds
            self.outer[some] = new.outer
        self.at = at
        return needed

    def _settle(self, rows: np.ndarray, own: np.ndarray, far: np.ndarray, deep: int, at: np.ndarray) -> None:
        """Order of the entries measured, the one at hand among them; the nearest is taken out, the others get exact bounds."""
        entry = np.concatenate([self.at[rows][:, None], self.near[rows][:, :deep]], axis=1)
        dist = np.concatenate([own[:, None], far], axis=1)
        unknown = dist == np.iinfo(np.int64).max
        order = np.lexsort((entry, dist), axis=1)  # unmeasured ones stay last, to be put back below
        best = order[:, 0]
        at[rows] = entry[np.arange(len(rows)), best]
        root = _down(np.sqrt(dist.astype(np.float64)))
        root = np.where(unknown, np.concatenate([np.zeros((len(rows), 1), np.float32), self.bounds[rows][:, :deep]], axis=1), root)
        stay = np.ones(dist.shape, dtype=bool)
        stay[np.arange(len(rows)), best] = False
        entry = entry[stay].reshape(len(rows), deep)
        root = root[stay].reshape(len(rows), deep)
        order = np.argsort(root, axis=1, kind="stable")
        self.near[rows, :deep] = np.take_along_axis(entry, order, 1)
        self.bounds[rows, :deep] = np.take_along_axis(root, order, 1)


def _packed(x: np.ndarray) -> pa.Array:
    """Rows of an array as binary values."""
    x = np.ascontiguousarray(x)
    flat = x.reshape(len(x), int(np.prod(x.shape[1:])))
    width = flat.shape[1] * flat.itemsize
    offsets = pa.py_buffer((np.arange(len(x) + 1, dtype=np.int32) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(flat.tobytes())])


def _unpacked(column: pa.Array, kind: object, *shape: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    flat = np.frombuffer(data, dtype=kind) if data else np.zeros(0, dtype=kind)
    return flat.reshape(len(column), *shape).copy()


_STATE = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("ints", pa.binary()), ("at", pa.binary()),
                    ("near", pa.binary()), ("bounds", pa.binary()), ("outer", pa.binary()), ("error", pa.int64()),
                    ("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64())), ("n", pa.int64()),
                    ("needed", pa.int64())])
_STATE_SQL = ("vec_id long, label string, ints binary, at binary, near binary, bounds binary, outer binary, error long, "
              "part int, entry int, sums array<long>, n long, needed long")  # fmt: skip


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    filled = [columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in _STATE]
    return pa.RecordBatch.from_arrays(filled, schema=_STATE)


def _task(book: Codebook, width: int, kind: str, keep: int, was: int | None, last: bool) -> Callable:
    """One round over the rows of a task: new state, then sums of the parts by entry and numbers of needed bounds.

    ``was`` is the number of bounds in the state, none in the first round; the ``last`` round keeps no bounds.
    """
    parts, entries = book.entries.shape[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        needs = np.zeros(entries + 1, dtype=np.int64)
        for whole in batches:
            for k in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(k, CHUNK)
                ints = _unpacked(batch.column("ints"), kind, parts, width)
                states = []
                for p in range(parts):
                    points = ints[:, p].astype(np.int64)
                    if was is None:
                        state = Part.fresh(points, book.entries[p], keep)
                    else:
                        state = Part(*(_unpacked(batch.column(c), t, parts, *s)[:, p].astype(u) for c, t, s, u in (
                            ("at", "u1", (), np.int64), ("near", "u1", (was,), np.int64),
                            ("bounds", "<f4", (was,), np.float32), ("outer", "<f4", (), np.float32))))
                        needed = state.step(points, book.entries[p], book.moved[p])
                        needs += np.bincount(needed, minlength=entries + 1)
                        state = state.shrunk(keep)
                    states.append(state)
                    if not last:
                        np.add.at(sums[p], state.at, points)
                        counts[p] += np.bincount(state.at, minlength=entries)
                at = np.stack([s.at for s in states], axis=1)
                rest = {"ints": batch.column("ints"), "near": _packed(np.stack([s.near for s in states], 1).astype("u1")),
                        "bounds": _packed(np.stack([s.bounds for s in states], 1).astype("<f4")),
                        "outer": _packed(np.stack([s.outer for s in states], 1).astype("<f4"))}
                if last:
                    apart = ints.astype(np.int64) - book.entries[np.arange(parts)[None], at]
                    rest = {"error": pa.array((apart * apart).sum((1, 2)))}
                yield _batch(vec_id=batch.column("vec_id"), label=batch.column("label"), at=_packed(at.astype("u1")), **rest)
        if not last:
            part, entry = np.nonzero(counts)
            if len(part):
                yield _batch(part=pa.array(part), entry=pa.array(entry), n=pa.array(counts[part, entry]),
                             sums=pa.array(list(sums[part, entry]), pa.list_(pa.int64())))
            used = np.flatnonzero(needs)
            if len(used):
                yield _batch(needed=pa.array(used), n=pa.array(needs[used]))

    return run


def _moved(book: Codebook, state: DataFrame, width: int) -> Codebook:
    """The codebook of floored means; entries without parts stay. ``PARTS x ENTRIES`` rows reach the driver."""
    sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    rows = state.where("part is not null").groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
    entries = book.entries.copy()
    for r in rows:
        entries[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    apart = (entries - book.entries).astype(np.float64)
    return Codebook(entries, _up(np.sqrt((apart * apart).sum(2))))


def _enough(state: DataFrame, keep: int) -> int:
    """Bounds to keep: as many as all but one in ``SPARE`` parts needed, never more than now."""
    rows = sorted((r.needed, r.n) for r in state.where("needed is not null").groupBy("needed").agg(F.sum("n").alias("n")).collect())
    total, seen = sum(n for _, n in rows), 0
    for needed, n in rows:
        seen += n
        if seen * SPARE >= total * (SPARE - 1):
            return max(min(LEAST_BOUNDS, keep), min(keep, needed))
    return keep


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, x``: rows whose vector has only finite components, as floors of ``SCALE`` times the component."""
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[label].cast("string").alias("label"),
                          vectors[vector].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    numbers = F.transform("vector", lambda x: F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), x * SCALE))))
    return rows.where(F.col("vector").isNotNull() & finite).select("vec_id", "label", numbers.alias("x"))


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 bounds: int = BOUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, at, error`` of every kept vector, and the codebooks ``[part, entry, position]``.

    ``at`` is one byte per part, the index of its entry; ``error`` the squared distance summed
    over the parts. A codebook begins as the parts of the vectors with the smallest ids (null
    ids last, repeated ids by their vector) and is replaced ``rounds`` times by floored means;
    equal distances go to the lower index. The state is written to the shared folder once a
    round, so a lost executor costs one round of its tasks.

    Rows whose vector is null or has a null or non-finite component are left out. Vectors
    shorter than the longest, or of a length that the parts do not divide, are filled up with
    zeros. Components beyond some 2^26 at 16 positions a part, where squares leave 64 bits, count as that bound. With fewer
    vectors than entries there are as many entries as vectors; repeated rows are vectors of
    their own; an empty table gives no rows and empty codebooks. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index must fit in a byte")
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, vec_id, vector, label)
    size = rows.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", lambda v: F.abs(v))))).first()
    width = -(-max(size[0] or 0, 1) // parts)
    limit = 1 << ((62 - (width * parts).bit_length()) // 2 - 1)
    kind = "<i2" if min(size[1] or 0, limit) < 1 << 15 else "<i4"
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    book = np.zeros((parts, len(first), width), dtype=np.int64)
    for k, r in enumerate(first):
        flat = np.zeros(parts * width, dtype=np.int64)
        flat[: len(r.x)] = [max(-limit, min(limit, v)) for v in r.x]
        book[:, k] = flat.reshape(parts, width)
    books = Codebook(book, np.zeros(book.shape[:2]))
    if not first:
        nothing = spark.createDataFrame([], "vec_id long, label string, at binary, error long")
        return nothing, book

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("x")
            n = np.diff(lists.offsets.to_numpy())
            flat = np.clip(lists.flatten().to_numpy(zero_copy_only=False), -limit, limit)
            out = np.zeros((batch.num_rows, parts * width), dtype=kind)
            out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat
            yield _batch(vec_id=batch.column("vec_id"), label=batch.column("label"), ints=_packed(out))

    packed = rows.mapInArrow(pack, _STATE_SQL)
    keep = was = max(0, min(bounds, len(first) - 1))
    state = stored(packed.mapInArrow(_task(books, width, kind, keep, None, rounds == 0), _STATE_SQL), "vector-codes")
    for k in range(rounds):
        books = _moved(books, state, width)
        held = state.where("at is not null")
        if k:
            keep = _enough(state, keep)
        step = _task(books, width, kind, keep, was, k == rounds - 1)
        state, was = stored(held.mapInArrow(step, _STATE_SQL), "vector-codes"), keep
    return state.select("vec_id", "label", "at", "error"), books.entries


def code_table(codes: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: hex codes, errors summed over equal labels, digest of the books.

    Sums are taken per label first, so a label of any size sends one row per task.
    """
    text = ",".join(map(str, codebooks.reshape(-1).tolist()))
    digest = hashlib.sha256(text.encode()).hexdigest()
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    both = codes.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return both.select("vec_id", F.lower(F.hex("at")).alias("code"), "error", "label_error",
                       F.lit(digest).alias("codebooks_sha256"))
