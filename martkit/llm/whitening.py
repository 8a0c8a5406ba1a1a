"""Operator 11: whitening of embeddings by leading principal components.

Entries become whole numbers x = floor(scale * entry) + offset.  Tasks sum them exactly; around the whole number next to
the mean they sum products of the centred rows, whose small remaining shift is taken off exactly, so nothing cancels
however large the offset is.  The covariance (divisor n) has a row's width squared; its leading eigenpairs come from
``symmetric_eigen``, and the projection, width times components, goes to all tasks in their closure.  Only sums
of one value for each pair of dimensions reach the driver, added up by Spark before.

Defined results: a row is left out if its vector is null or empty, holds a null or a non-finite entry, or an entry whose
whole number passes 2**50; of vectors of several lengths those of the most frequent length are fitted (ties: the longer)
and the others are left out; rows with a null vec_id and repeated rows are rows like others; a component without
variance (up to rounding, 2**-40 of the trace) is not a component, so constant data give no rows; a deviation
that passes a long is null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.symmetric_eigen import leading_eigenpairs

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST = 1 << 50      # larger whole numbers are not summed exactly
ROWS = 1 << 11         # rows multiplied at a time, a few MB of them
NOISE = 2.0 ** -40


def whole_vectors(b: pa.RecordBatch, width: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(usable rows, their x-vectors) of a batch; ``width`` None: the widths of usable rows instead."""
    col = b.column(b.schema.get_field_index("vec"))
    n = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(col)
    bad = pc.is_null(flat).to_numpy(zero_copy_only=False)
    v = flat.fill_null(0.0).cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(v * SCALE) + OFFSET
        bad = bad | ~np.isfinite(v) | ~(np.abs(x) <= LARGEST)
    row = np.repeat(np.arange(len(n)), n)
    ok = (n > 0) & (np.bincount(row[bad], minlength=len(n)) == 0)
    if width is None:
        return np.flatnonzero(ok), n[ok]
    ok &= n == width
    return np.flatnonzero(ok), x[ok[row]].astype(np.int64).reshape(-1, width)


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    step = max(1, ROWS * 64 // max(64, width))
    for b in batches:
        for i in range(0, b.num_rows, step):
            part = b.slice(i, step)
            yield part, *whole_vectors(part, width)


_WIDTHS = "width long, n long"


def _widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        width, n = np.unique(whole_vectors(b, None)[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(width), pa.array(n)], names=["width", "n"])


_SUMS = "i int, total long"


def _sums(width: int):
    """Exact sums by dimension, sent on before they can overflow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = pa.array(np.arange(width, dtype=np.int32))
        total, bound = np.zeros(width, np.int64), 0
        for _, _, x in _pieces(batches, width):
            if not len(x):
                continue
            more = len(x) * int(np.abs(x).max())
            if bound + more >= 1 << 62:
                yield pa.RecordBatch.from_arrays([at, pa.array(total)], names=["i", "total"])
                total, bound = np.zeros(width, np.int64), 0
            total, bound = total + x.sum(axis=0), bound + more
        yield pa.RecordBatch.from_arrays([at, pa.array(total)], names=["i", "total"])

    return run


_CELLS = "i int, j int, value double"


def _products(width: int, centre: np.ndarray, weights: np.ndarray | None = None, shift: np.ndarray | None = None):
    """Sums of products of centred rows (projected, if weights are given), one row for each pair i <= j."""
    size = width if weights is None else weights.shape[1]
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        some = False
        for _, _, x in _pieces(batches, width):
            y = (x - centre).astype(np.float64)
            if weights is not None:
                y = (y - shift) @ weights
            total += y.T @ y
            some = some or len(y) > 0
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array(total[i, j])], names=["i", "j", "value"])

    return run


@dataclass
class Whitener:
    """A fitted projection: rows minus centre minus shift, times weights."""

    n: int
    width: int
    centre: np.ndarray    # whole numbers next to the means
    shift: np.ndarray     # means minus centre
    rest: np.ndarray      # n times shift, exact
    weights: np.ndarray   # components over the roots of their eigenvalues, width x components
    explained: np.ndarray

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exact; None if it passes a long."""
        if not len(x):
            return []
        y = x - self.centre
        if (int(np.abs(y).max()) * self.n + self.n) ** 2 * self.width < 1 << 63:
            z = y * self.n - self.rest
            return (z * z).sum(axis=1).tolist()
        rest = self.rest.tolist()
        sums = [sum((a * self.n - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in y.tolist()]
        return [s if s < 1 << 63 else None for s in sums]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.shift) @ self.weights


def _vectors(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").alias("vec"))


def _square(cells: DataFrame, size: int) -> np.ndarray:
    """Pair sums added up by Spark, one value for each pair."""
    out = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on all usable vectors; None if there are none."""
    rows = _vectors(vectors)
    widths = rows.mapInArrow(_widths, _WIDTHS).groupBy("width").agg(F.sum("n").alias("n")).orderBy(
        F.col("n").desc(), F.col("width").desc()).first()
    if widths is None:
        return None
    width, n = int(widths.width), int(widths.n)
    total = [0] * width
    for r in rows.mapInArrow(_sums(width), _SUMS).groupBy("i").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        total[r.i] = int(r.total)
    centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    rest = np.array([s - n * int(c) for s, c in zip(total, centre, strict=True)], np.int64)
    shift = rest / n
    v = _square(rows.mapInArrow(_products(width, centre), _CELLS), width) / n - np.outer(shift, shift)
    values, parts = leading_eigenpairs(v, components)
    trace = float(np.trace(v))
    real = values > NOISE * max(trace, 0.0)
    values, parts = values[real], parts[real]
    return Whitener(n, width, centre, shift, rest, (parts / np.sqrt(values)[:, None]).T, values / trace if trace else values)


def identity_error(vectors: DataFrame, w: Whitener) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured on all rows."""
    size = w.weights.shape[1]
    cov = _square(_vectors(vectors).mapInArrow(_products(w.width, w.centre, w.weights, w.shift), _CELLS), size) / w.n
    return float(np.abs(cov - np.eye(size)).max())


_ROWS = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
         "identity_error double")


def _project(w: Whitener, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = w.weights.shape[1]
        for b, at, x in _pieces(batches, w.width):
            if not len(at):
                continue
            ids = b.column("vec_id").take(pa.array(np.repeat(at, k)))
            m = len(at) * k
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(m, w.n, np.int64)),
                pa.array(w.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                pa.array(w.whiten(x).ravel()), pa.array(np.tile(w.explained, len(at))), pa.array(np.full(m, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component."""
    w = fit(vectors, components)
    if w is None or not w.weights.shape[1]:
        return vectors.sparkSession.createDataFrame([], _ROWS)
    return _vectors(vectors).mapInArrow(_project(w, identity_error(vectors, w)), _ROWS)
