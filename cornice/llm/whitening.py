"""Whitening of vectors by a tall-skinny QR, without ever forming their covariance.

Components become whole numbers, x = floor(64 c) + 1000000, so sums over any
number of rows are exact.  The fit list is each distinct x vector once.  Rows are
centred by the exact sums, each task reduces its rows to one triangular R, and the
R factors are merged in a tree of small groups until one is left.  Its singular
value decomposition gives the directions and variances: the covariance is R'R / n,
and R is at most as wide as a vector.

Defined cases: rows whose vector is null, empty or holds a null or non-finite
entry take no part, nor do vectors whose length isn't the commonest one (of equally
common ones the longer).  A null vec_id is kept as such, and rows that repeat an id
or a vector each give their rows.  Directions without variance (an eigenvalue of at
most 1e-12 of the largest) can't be scaled and are left out, so a table with one
distinct vector gives no rows, as an empty one does.  A deviation beyond a long is
null; sums, or n times a component, beyond a long raise an error.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, scope

SCALE = 64
SHIFT = 1000000
COMPONENTS = 16
#: Bytes of factors that one task of the merge holds, and the most of them it takes.
MERGE_BYTES = 64 << 20
FAN_IN = 32
NO_VARIANCE = 1e-12
LONG = float(1 << 63)


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the rows that take part."""
    v = F.col(f"`{vector}`")
    sound = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = table.where((F.size(v) > 0) & sound).select(F.col(f"`{vec_id}`").alias("id"), x.alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == (sizes[0]["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fits(x: np.ndarray) -> np.ndarray:
    if x.size and np.abs(x).max() >= LONG:
        raise OverflowError("sums of these vectors don't fit a long")
    return x


def exact_sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and their sum by dimension, exact; the driver gets a number a dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(0))
                _fits(np.abs(x.astype(float)).sum(0) + np.abs(np.asarray(total, dtype=float)))
                n, total = n + len(x), total + x.sum(0)
        if n:
            d = len(total)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d), pa.array(total)], ["dim", "n", "total"])

    found = fit.select("x").mapInArrow(add, "dim int, n long, total long").groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = sorted(found.collect())
    return (rows[0].n if rows else 0), np.array([r.total for r in rows], dtype=np.int64)


def scaled(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n times each row's distance from the mean, as exact longs."""
    _fits(np.abs(x.astype(float)) * n + np.abs(total.astype(float)))
    return x * np.int64(n) - total


def _pack(*arrays: np.ndarray) -> bytes:
    return np.concatenate([np.asarray(a, dtype=np.float64).ravel() for a in arrays]).tobytes()


def tree_merge(parts: DataFrame, merge: Callable[[list[bytes]], bytes], size: int, n_parts: int) -> bytes | None:
    """One value out of (part, value): groups of a bounded size are merged until one is left."""
    fan = max(2, min(FAN_IN, MERGE_BYTES // max(1, size)))

    def step(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "value": [merge(list(pdf.sort_values("part")["value"]))]})

    while n_parts > 1:
        parts = parts.groupBy(F.floor(F.col("part") / fan).alias("to")).applyInPandas(step, "part long, value binary")
        n_parts = -(-n_parts // fan)
    found = parts.collect()
    return bytes(found[0]["value"]) if found else None


def r_factor(fit: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """R of a QR decomposition of the centred rows."""
    d = len(total)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            if len(batch):
                rows = scaled(_matrix(batch.column(0)), n, total).astype(float) / n
                r = np.linalg.qr(np.vstack((r, rows)), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_pack(r)])], ["part", "value"])

    def merge(values: list[bytes]) -> bytes:
        return _pack(np.linalg.qr(np.vstack([np.frombuffer(v).reshape(-1, d) for v in values]), mode="r"))

    rows = fit.select("x")
    found = tree_merge(rows.mapInArrow(reduce, "part long, value binary"), merge, d * d * 8, rows.rdd.getNumPartitions())
    return np.frombuffer(found).reshape(-1, d)


class Whitening:
    """Mean, directions (a column each), eigenvalues and shares of variance of a fit list."""

    def __init__(self, n: int, total: np.ndarray, r: np.ndarray, components: int = COMPONENTS):
        _, s, vt = np.linalg.svd(r, full_matrices=False)
        e = s * s / n
        k = int((e[:components] > NO_VARIANCE * e[0]).sum()) if len(e) else 0
        self.n, self.total = n, total
        self.directions, self.e, self.explained = vt[:k].T.copy(), e[:k], e[:k] / max(e.sum(), np.finfo(float).tiny)

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Deviation of each row, exact where a long holds it and else masked, and its whitened components."""
        far = scaled(x, self.n, self.total)
        near = far.astype(float)
        small = (near * near).sum(1) < LONG * 0.999
        deviation = np.where(small, (np.where(small[:, None], far, 0) ** 2).sum(1), 0)
        return np.ma.array(deviation, mask=~small), (near / self.n) @ self.directions / np.sqrt(self.e)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    n, total = exact_sums(fit)
    return Whitening(n, total, r_factor(fit, n, total), components) if n else None


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry by which the covariance of the whitened fit list differs from the identity.

    Tasks give count, mean and centred products of their rows; merging keeps the products centred.
    """
    k = len(model.e)

    def join(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        gap = b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if len(batch):
                w = model.apply(_matrix(batch.column(0)))[1]
                mean = w.mean(0)
                one = (float(len(w)), mean, (w - mean).T @ (w - mean))
                state = join(state, one) if state else one
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_pack(*state)])], ["part", "value"])

    def read(value: bytes) -> tuple:
        a = np.frombuffer(value)
        return a[0], a[1 : k + 1], a[k + 1 :].reshape(k, k)

    def merge(values: list[bytes]) -> bytes:
        state = read(values[0])
        for value in values[1:]:
            state = join(state, read(value))
        return _pack(*state)

    rows = fit.select("x")
    found = tree_merge(rows.mapInArrow(gather, "part long, value binary"), merge, (k * k + k + 1) * 8, rows.rdd.getNumPartitions())
    n, _, products = read(found)
    return float(np.abs(products / n - np.eye(k)).max())


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: id, component, n, deviation, whitened, explained, identity_error."""
    kind = dict(table.dtypes)[vec_id]
    schema = f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = usable(table, vec_id, vector)
    with scope(table.sparkSession):
        fit = materialize(rows.select("x").distinct(), "fit-list")
        model = fit_whitening(fit, components)
        if model is None or not len(model.e):
            return table.sparkSession.createDataFrame([], schema)
        error = identity_error(fit, model)
    k = len(model.e)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            if not m:
                continue
            deviation, w = model.apply(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, dtype=np.int64)),
                    pa.array(np.repeat(deviation.data, k), mask=np.repeat(np.ma.getmaskarray(deviation), k)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(give, schema)
