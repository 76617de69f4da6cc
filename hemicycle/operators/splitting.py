"""K-means for every cluster count from one to a limit, in shared passes over the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.vectors import to_vector

#: Rows whose distances to all centres are held at once.
TILE = 4096


@dataclass
class SplitSets:
    """Centre sets by cluster count; the set of ``k`` clusters is ``centres[k - 1]``.

    ``sizes`` and ``spreads`` hold, per set, the rows of each cluster and their squared
    distances from its centre, ``silhouettes`` one score a set (NaN below two filled clusters).
    """

    centres: list[np.ndarray]
    sizes: list[np.ndarray]
    spreads: list[np.ndarray]
    silhouettes: list[float]

    def scores(self, spark) -> DataFrame:
        """``(k, filled, inertia, silhouette)``."""
        rows = [
            (k + 1, int((n > 0).sum()), float(w.sum()), score)
            for k, (n, w, score) in enumerate(zip(self.sizes, self.spreads, self.silhouettes))
        ]
        return spark.createDataFrame(rows, "k int, filled int, inertia double, silhouette double")


def split_sets(df: DataFrame, vector: str, max_k: int, rounds: int = 10, tolerance: float = 0.0) -> SplitSets:
    """Centre sets of 1 to ``max_k`` clusters.

    Every pass over the rows assigns each row in all sets there are and sums up all their
    clusters; the next set starts from the largest one, its widest cluster cut in two at one
    standard deviation on either side of the mean, on the coordinate that varies most. Once all sets
    exist, all are refined together for ``rounds`` passes, or until no coordinate of any centre moves
    more than ``tolerance``. Ties go to the lower cluster or coordinate; a cluster without rows keeps its centre.

    Tasks and driver hold ``max_k * (max_k + 1) / 2`` centres, whatever the number of rows.
    Each pass reads the vector column again, so store a costly ``df`` first. Rows whose vector
    is null or holds a null or non-finite number have no part in the fit; a vector of another
    length than the first is an error. Without rows there are no sets.
    """
    rows = df.select(F.col(vector).cast("array<double>").alias("x")).filter(F.col("x").isNotNull())
    first = rows.first()
    if first is None:
        return SplitSets([], [], [], [])
    width = len(first["x"])
    sets = [np.zeros((1, width))]
    n, sums, _ = _cluster_sums(rows, sets)
    if not n[0][0]:
        return SplitSets([], [], [], [])
    sets = [sums[0] / n[0][0]]
    left = rounds
    while len(sets) < max_k or left > 0:
        n, sums, squares = _cluster_sums(rows, sets)
        moved = [_means(c, m, s) for c, m, s in zip(sets, n, sums)]
        shift = max(np.abs(a - b).max(initial=0.0) for a, b in zip(moved, sets))
        if len(sets) < max_k:
            moved.append(_split(sets[-1], moved[-1], n[-1], squares[-1]))
        else:
            left = left - 1 if shift > tolerance else 0
        sets = moved
    n, sums, squares = _cluster_sums(rows, sets)
    return SplitSets(sets, n, [s.sum(axis=1) for s in squares], _silhouettes(rows, sets, n, sums, squares))


def with_split_labels(df: DataFrame, vector: str, centres: Sequence[np.ndarray], names: Sequence[str]) -> DataFrame:
    """The input with one column a centre set, the cluster of each row; null where the vector cannot be used."""
    taken = set(names) & set(df.columns)
    if taken:
        raise ValueError(f"columns exist: {sorted(taken)}")
    schema = StructType(df.schema.fields + [StructField(n, IntegerType()) for n in names])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, x = _usable(batch.column(vector), centres[0].shape[1])
            for name, found in zip(names, _assign(x, centres)):
                values = np.zeros(batch.num_rows, dtype=np.int32)
                known = np.zeros(batch.num_rows, dtype=bool)
                values[where], known[where] = found, True
                batch = batch.append_column(name, pa.array(values, mask=~known))
            yield batch

    return df.mapInArrow(label, schema)


# --- one pass ----------------------------------------------------------------


def _usable(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors without null or non-finite numbers, and their matrix."""
    where = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lengths = pc.list_value_length(column).drop_null()
    if len(lengths) and pc.any(pc.not_equal(lengths, width)).as_py():
        raise ValueError(f"vectors must all have {width} numbers")
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = values.reshape(len(where), width)
    finite = np.isfinite(x).all(axis=1)
    return where[finite], x[finite]


def _assign(x: np.ndarray, sets: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Nearest centre of each row in every set; of equal centres the first counts."""
    flat = np.concatenate(sets)
    squares, ends = (flat * flat).sum(axis=1), np.cumsum([len(s) for s in sets])
    first = [np.array([np.flatnonzero((s == c).all(axis=1))[0] for c in s], dtype=np.int32) for s in sets]
    found = [np.empty(len(x), dtype=np.int32) for _ in sets]
    for start in range(0, len(x), TILE):
        # The square of the row itself is the same for all centres.
        distance = squares - 2.0 * x[start : start + TILE] @ flat.T
        for out, part, own in zip(found, np.split(distance, ends[:-1], axis=1), first):
            out[start : start + TILE] = own[part.argmin(axis=1)]
    return found


def _added(rows: DataFrame, slots: int, width: int, partial: _ClusterPart | _SilhouettePart) -> np.ndarray:
    """``slots x size`` numbers that ``partial`` adds up per task, summed over the tasks in two steps."""
    size = partial.size

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((slots, size))
        for batch in batches:
            x = _usable(batch.column(0), width)[1]
            if len(x):
                partial(x, total)
        yield pa.RecordBatch.from_pydict(
            {"slot": pa.array(range(slots), pa.int32()), "total": pa.array(list(total), pa.list_(pa.float64()))}
        )

    total = vector_to_array(Summarizer.sum(to_vector(F.col("total")))).alias("total")
    summed = (
        rows.mapInArrow(task, "slot int, total array<double>")
        .withColumn("_part", F.spark_partition_id() % 256)
        .groupBy("slot", "_part")
        .agg(total)
        .groupBy("slot")
        .agg(total)
    )
    out = np.zeros((slots, size))
    for r in summed.collect():
        out[r["slot"]] = r["total"]
    return out


class _ClusterPart:
    """Adds the rows of every cluster: their number, sum and squares around the centre."""

    def __init__(self, sets: Sequence[np.ndarray]):
        self.sets, self.size = sets, 1 + 2 * sets[0].shape[1]

    def __call__(self, x: np.ndarray, total: np.ndarray) -> None:
        slot = 0
        for centres, found in zip(self.sets, _assign(x, self.sets)):
            for c, centre in enumerate(centres):
                part = x[found == c]
                total[slot] += np.concatenate([[len(part)], part.sum(axis=0), ((part - centre) ** 2).sum(axis=0)])
                slot += 1


def _cluster_sums(rows: DataFrame, sets: Sequence[np.ndarray]) -> tuple[list, list, list]:
    width, lengths = sets[0].shape[1], [len(s) for s in sets]
    total = _added(rows, sum(lengths), width, _ClusterPart(sets))
    parts = np.split(total, np.cumsum(lengths)[:-1])
    return [p[:, 0] for p in parts], [p[:, 1 : 1 + width] for p in parts], [p[:, 1 + width :] for p in parts]


def _means(centres: np.ndarray, n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)


def _scatter(centres: np.ndarray, means: np.ndarray, n: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Squares around the means from squares around the centres."""
    return np.maximum(squares - n[:, None] * (means - centres) ** 2, 0.0)


def _split(centres: np.ndarray, means: np.ndarray, n: np.ndarray, squares: np.ndarray) -> np.ndarray:
    scatter = _scatter(centres, means, n, squares)
    widest = int(scatter.sum(axis=1).argmax())
    i = int(scatter[widest].argmax())
    deviation = np.sqrt(scatter[widest, i] / max(n[widest], 1))
    out = np.vstack([means, means[widest]])
    out[widest, i] -= deviation
    out[-1, i] += deviation
    return out


# --- scores ------------------------------------------------------------------


class _SilhouettePart:
    """Adds the squared-Euclidean silhouette of every row, and counts rows, per set.

    The mean squared distance of a row from a cluster is the one from its mean plus the
    cluster's scatter, so a row meets clusters only.
    """

    size = 2

    def __init__(self, sets, n, means, scatter):
        self.sets, self.n, self.means, self.scatter = sets, n, means, scatter

    def __call__(self, x: np.ndarray, total: np.ndarray) -> None:
        for start in range(0, len(x), TILE):
            tile = x[start : start + TILE]
            for k, found in enumerate(_assign(tile, self.sets)):
                total[k] += self._of_set(tile, k, found), len(tile)

    def _of_set(self, x: np.ndarray, k: int, found: np.ndarray) -> float:
        n, rows = self.n[k], np.arange(len(x))
        away = np.stack([((x - m) ** 2).sum(axis=1) for m in self.means[k]], axis=1) + self.scatter[k] / np.maximum(n, 1)
        away[:, n == 0] = np.inf
        own = n[found]
        a = away[rows, found] * own / np.maximum(own - 1, 1)
        away[rows, found] = np.inf
        b = away.min(axis=1)
        top = np.maximum(a, b)
        known = np.isfinite(b) & (top > 0) & (own > 1)
        return float(((b - a)[known] / top[known]).sum())


def _silhouettes(rows: DataFrame, sets, n, sums, squares) -> list[float]:
    means = [_means(c, m, s) for c, m, s in zip(sets, n, sums)]
    scatter = [_scatter(c, m, k, q).sum(axis=1) for c, m, k, q in zip(sets, means, n, squares)]
    total = _added(rows, len(sets), sets[0].shape[1], _SilhouettePart(sets, n, means, scatter))
    filled = [int((k > 0).sum()) for k in n]
    return [float(t[0] / t[1]) if f > 1 else float("nan") for t, f in zip(total, filled)]
