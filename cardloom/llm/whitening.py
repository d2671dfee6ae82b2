"""Whitening of vectors: principal components of whole-number vectors, scaled to unit variance.

Each partition computes its count, its sums and its scatter about its own mean; Chan's formula merges
two of these, in a tree over the executors.  The driver gets one scatter matrix, decomposes it, and
a second pass over the same vectors merges the scatter of the whitened ones, whose covariance must be
the identity.

An entry c becomes the whole number floor(64 * c) + 1000000.  Counts and sums are whole numbers
throughout, so the mean is exact, and every difference from it is taken before anything is multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import settle

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this are taken as it, so that every number fits a long.
LARGEST = 1 << 52
#: Partial results that one task or the driver merges.
WIDTH = 8


@dataclass(frozen=True)
class Moments:
    """Count, sums of each dimension as whole numbers, and scatter about the mean."""

    n: int
    sums: tuple[int, ...]
    scatter: np.ndarray


def moments(rows: np.ndarray) -> Moments:
    """Of the rows of an array of whole numbers (int64) or of doubles; at least one row."""
    if rows.dtype == np.int64:
        base = rows[0]
        near = rows - base  # small numbers, whose mean is exact to the last digit
        sums = tuple(int(b) * len(rows) + int(s) for b, s in zip(base, near.sum(axis=0, dtype=object) if np.abs(near).max(initial=0) > 1 << 40 else near.sum(axis=0)))
        centred = near - near.mean(axis=0)
    else:
        sums = tuple(rows.sum(axis=0).tolist())
        centred = rows - rows.mean(axis=0)
    return Moments(len(rows), sums, centred.T @ centred)


def merged(x: Moments, y: Moments) -> Moments:
    """Chan's formula.  The difference of the means is one division of whole numbers for whole-number sums."""
    step = np.array([(b * x.n - a * y.n) / (x.n * y.n) for a, b in zip(x.sums, y.sums)])
    return Moments(x.n + y.n, tuple(a + b for a, b in zip(x.sums, y.sums)), x.scatter + y.scatter + np.outer(step, step) * (x.n * y.n / (x.n + y.n)))


def _gathered(vectors: DataFrame, rows_of: Callable[[np.ndarray], np.ndarray]) -> Moments | None:
    """Moments of what rows_of makes of the vectors (column x, equal lengths), merged in a tree; None without rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Moments | None = None
        for batch in batches:
            if len(batch):
                own = moments(rows_of(_matrix(batch.column(0))))
                held = own if held is None else merged(held, own)
        if held is not None:
            yield pa.record_batch([pa.array([held.n]), pa.array([[str(s) for s in held.sums]]), pa.array([held.scatter.tobytes()])], ["n", "sums", "scatter"])

    def restored(row) -> Moments:
        d = len(row["sums"])
        number = int if all(s.lstrip("-").isdigit() for s in row["sums"]) else float
        return Moments(row["n"], tuple(number(s) for s in row["sums"]), np.frombuffer(row["scatter"], np.float64).reshape(d, d))

    parts = settle(vectors.select("x").mapInArrow(partial, "n long, sums array<string>, scatter binary"))
    if parts.isEmpty():
        return None
    own = parts.rdd.map(restored)
    return own.treeReduce(merged, max(1, math.ceil(math.log(own.getNumPartitions(), WIDTH))))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of lists of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def numbers(vector: Column) -> Column:
    """A vector's whole numbers; those beyond LARGEST are taken as it."""
    large = F.lit(float(LARGEST))
    return F.transform(vector, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), large), -large).cast("long") + SHIFT)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows whose vectors have entries, all finite, and the length that most of these have (of equals the greatest)."""
    column = F.col(f"`{vector}`").cast("array<double>")
    whole = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), column.alias("v")).where((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf)))
    length = whole.groupBy(F.size("v").alias("d")).count().agg(F.max(F.struct("count", "d"))["d"].alias("d")).first()["d"]
    return whole.where(F.size("v") == F.lit(length)).select("vec_id", numbers(F.col("v")).alias("x"))


@dataclass(frozen=True)
class Whitening:
    """n and sums of the list that was fitted, components as columns with their eigenvalues, and how far the whitened list is from the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean for rows of whole numbers: whole parts are subtracted as such, so nothing large is rounded."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - base) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum)^2, exact; null where it doesn't fit a long."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        near = x - base
        largest = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if largest**2 * x.shape[1] < 1 << 63:
            return ((near * self.n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        every = [sum((int(v) * self.n - r) ** 2 for v, r in zip(row, rest)) for row in near]
        return [v if v < 1 << 63 else None for v in every]


def fitted(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From distinct whole-number vectors (column x) of one length; None if there is none or all variance is zero.

    Components whose eigenvalue is nothing but rounding are left out.
    """
    found = _gathered(distinct, lambda x: x)
    if found is None:
        return None
    covariance = found.scatter / found.n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values > max(values[0], 0) * len(values) * 64 * np.finfo(np.float64).eps).sum())
    if not kept:
        return None
    kept = min(kept, components)
    model = Whitening(found.n, found.sums, np.ascontiguousarray(vectors[:, :kept]), values[:kept].copy(), values[:kept] / np.trace(covariance), math.nan)
    again = _gathered(distinct, model.whitened)
    error = float(np.abs(again.scatter / again.n - np.eye(kept)).max())
    return Whitening(model.n, model.sums, model.components, model.values, model.explained, error)


_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each row with a usable vector and each component.

    Vectors that are null, empty or hold null or non-finite entries take no part, nor do those of another length than
    most have.  The fit counts equal vectors once; every row is whitened, repeated ones too, and ids may be null.
    Components without variance are left out; if there is none, as for an empty table, there are no rows.  Other columns are not read.
    """
    own = usable(rows, vec_id, vector)
    model = fitted(settle(own.select("x").distinct()), components)
    if model is None:
        return rows.sparkSession.createDataFrame([], _ROWS)
    k = len(model.values)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, each = _matrix(batch.column(1)), np.repeat(np.arange(len(batch)), k)
            deviations = pa.array(model.deviations(x), pa.int64())
            columns = [
                batch.column(0).take(each), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(each), model.n), deviations.take(each),
                model.whitened(x).ravel(), np.tile(model.explained, len(x)), np.full(len(each), model.error),
            ]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [c.split()[0] for c in _ROWS.split(", ")])

    return own.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(applied, _ROWS)
