"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors are written as integers, x = floor(256 c). The fit list holds each
distinct integer vector once, however often it is repeated.

1. Rows become integer vectors, packed to the least width that holds them, and
   are made distinct by a partial and a final aggregate, so that a vector with
   a third of all rows is one row a task before the shuffle.
2. One pass over the fit list counts it and adds up each dimension, exactly.
3. A second pass subtracts the whole number nearest to each mean and adds up
   the products; a task sends one row for each dimension. What the rounding of
   the means leaves is taken off with the exact sums, so the scatter is centred
   before it is multiplied and, below 2**53, free of rounding.
4. The scatter (dimensions squared, whatever the number of rows) is factored on
   the driver, P' S P = L L', with pivots of falling size. One-sided Jacobi
   rotates pairs of columns of L until all are orthogonal: their squared norms
   are the eigenvalues of S, the normalised columns its components.
5. A third pass over the fit list measures the covariance of what comes out.

Defined cases: rows take part if their vector is not null and holds no null or
non-finite entry, none too large to be written as a long, and as many entries
as most such rows (ties: more). Repeated and null ids keep their own rows.
Components of an eigenvalue that rounding cannot tell from zero are left out,
so equal vectors, one vector or an empty table give no rows. ``deviation`` is
null where it exceeds a long. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import importable, written

SCALE, COMPONENTS = 256, 4
#: Entries worked on at a time.
BLOCK = 1 << 21
_LONG = 1 << 63


def _packed(x: np.ndarray) -> list[bytes]:
    """Rows of longs as bytes: the least width that holds the row, its entries."""
    out: list = [b"\x01"] * len(x)
    if not x.size:
        return out
    high, low = x.max(axis=1), x.min(axis=1)
    width = np.ones(len(x), np.int64)
    for w in (1, 2, 4):
        width[(high >= 1 << (8 * w - 1)) | (low < -(1 << (8 * w - 1)))] = 2 * w
    for w in (1, 2, 4, 8):
        at = np.flatnonzero(width == w)
        raw, step = x[at].astype(f"<i{w}").tobytes(), w * x.shape[1]
        for k, row in enumerate(at.tolist()):
            out[row] = bytes((w,)) + raw[k * step : (k + 1) * step]
    return out


def _unpacked(blobs: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(blobs), size), np.int64)
    width = np.array([b[0] for b in blobs])
    for w in (1, 2, 4, 8) if size else ():
        at = np.flatnonzero(width == w)
        if len(at):
            out[at] = np.frombuffer(b"".join([blobs[k][1:] for k in at.tolist()]), f"<i{w}").reshape(len(at), size)
    return out


def _sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def integer_rows(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key, size and x (the packed integer vector) of the rows that take part,
    whatever their size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, 4096):
            batch = batch.filter(batch.column(1).is_valid())
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten()
            value = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE  # null: nan
            row = np.repeat(np.arange(len(sizes)), sizes)
            bad = ~(np.abs(value) < _LONG)
            use = np.bincount(row, bad, len(sizes)) == 0
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes[use]).tolist():
                of_size = np.flatnonzero(use & (sizes == size))
                step = max(1, BLOCK // max(size, 1))
                for at in np.split(of_size, range(step, len(of_size), step)):
                    x = np.floor(value[starts[at][:, None] + np.arange(size)]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([size] * len(at), pa.int32()), pa.array(_packed(x), pa.binary())], [key, "size", "x"])

    importable(vectors.sparkSession)
    rows = vectors.select(key, F.col(column).cast("array<double>"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, size int, x binary")


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The factor L (as many columns as the rank) and the order of the pivots:
    a[order][:, order] = L L'."""
    a, d = a.copy(), len(a)
    order, factor, rank = np.arange(d), np.zeros_like(a), 0
    least = d * np.finfo(float).eps * float(a.diagonal().max(initial=0.0))
    while rank < d:
        pivot = rank + int(np.argmax(a.diagonal()[rank:]))
        if not a[pivot, pivot] > least:
            break
        swap = [pivot, rank]
        a[[rank, pivot]], order[[rank, pivot]], factor[[rank, pivot]] = a[swap], order[swap], factor[swap]
        a[:, [rank, pivot]] = a[:, swap]
        column = a[rank:, rank] / np.sqrt(a[rank, rank])
        factor[rank:, rank] = column
        a[rank + 1 :, rank + 1 :] -= np.outer(column[1:], column[1:])
        rank += 1
    return factor[:, :rank], order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotates pairs of columns until all are orthogonal to rounding. A round
    rotates disjoint pairs at once; a sweep meets every pair."""
    x = np.ascontiguousarray(factor.T)  # columns as rows
    k = len(x)
    seats = np.arange(k + k % 2)
    close = max(factor.shape) * np.finfo(float).eps
    for _ in range(sweeps):
        apart = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            real = (p < k) & (q < k)
            p, q = p[real], q[real]
            a, b, c = (x[p] ** 2).sum(1), (x[q] ** 2).sum(1), (x[p] * x[q]).sum(1)
            off = np.abs(c) / np.sqrt(a * b)
            apart = max(apart, float(off.max(initial=0.0)))
            turn = off > close
            p, q, a, b, c = p[turn], q[turn], a[turn], b[turn], c[turn]
            z = (b - a) / (2 * c)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.sqrt(1 + z * z))
            cos = 1 / np.sqrt(1 + t * t)
            cos, sin = cos[:, None], (cos * t)[:, None]
            x[p], x[q] = cos * x[p] - sin * x[q], sin * x[p] + cos * x[q]
            seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])
        if apart <= close:
            break
    return x.T


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (as rows) of a symmetric
    matrix without negative ones, but for those lost in rounding."""
    factor, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned**2).sum(0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.zeros((len(by), len(scatter)))
    vectors[:, order] = (turned / norms).T[by]
    return norms[by] ** 2, vectors


@dataclass
class Whitening:
    """A fitted whitening: n vectors of the fit list, their exact sums by
    dimension, whole numbers near the means, and the components."""

    n: int
    sums: list[int]
    centre: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        rest = np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, self.centre)])
        return _from_centre(x, self.centre) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) squared; None beyond a long."""
        most = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums), default=0)
        if len(self.sums) * most * most < _LONG:
            apart = x * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < _LONG else None for v in exact]


def _from_centre(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    far = np.abs(x).max(initial=0) >= _LONG >> 2
    return x.astype(np.float64) - centre if far else (x - centre).astype(np.float64)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in _sliced(batches, max(1, BLOCK // max(size, 1))):
        yield _unpacked(batch.column(0).to_pylist(), size)


def _totals(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows of the fit list, and its sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for x in _blocks(batches, size):
            n += len(x)
            safe = np.abs(x).max(initial=0) < _LONG // BLOCK
            sums = [a + b for a, b in zip(sums, x.sum(0).tolist() if safe else map(sum, zip(*x.tolist())))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), pa.array([Decimal(n), *map(Decimal, sums)], pa.decimal128(38, 0))], ["place", "s"])

    rows = fit.mapInArrow(run, "place int, s decimal(38,0)").groupBy("place").agg(F.sum("s").alias("s")).collect()  # a row for each dimension
    found = {r.place: int(r.s) for r in rows}
    return found.get(-1, 0), [found.get(k, 0) for k in range(size)]


def _products(fit: DataFrame, size: int, wide: int, project) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products and sums of ``project`` (x -> rows of ``wide`` numbers)
    over the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((wide, wide + 1))
        for x in _blocks(batches, size):
            y = project(x)
            whole[:, :wide] += y.T @ y
            whole[:, wide] += y.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(wide), pa.int32()), pa.array(whole.tolist(), pa.list_(pa.float64()))], ["place", "s"])

    def add(rows: pa.Table) -> pa.Table:  # a row a task
        whole = rows.column("s").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        return pa.table({"place": rows.column("place")[:1], "s": pa.array([whole.sum(0).tolist()], pa.list_(pa.float64()))})

    schema = "place int, s array<double>"
    rows = fit.mapInArrow(run, schema).groupBy("place").applyInArrow(add, schema).collect()  # a row for each of ``wide``
    whole = np.zeros((wide, wide + 1))
    for r in rows:
        whole[r.place] = r.s
    return whole[:, :wide], whole[:, wide]


def fit_whitening(rows: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """From `integer_rows`, all of one size; None without a component."""
    fit = written(rows.select("x").distinct(), "whitening-fit")
    size = rows.select("size").first()
    if size is None:
        return None
    size = size[0]
    n, sums = _totals(fit, size)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    products, _ = _products(fit, size, size, lambda x: _from_centre(x, centre))
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], np.float64)
    scatter = products - np.outer(rest, rest) / n
    values, vectors = eigen(scatter)
    if not len(values):
        return None
    values = values[:most] / n
    model = Whitening(n, sums, centre, values, vectors[:most], float(scatter.trace() / n))
    products, added = _products(fit, size, len(values), model.whitened)
    covariance = products / n - np.outer(added / n, added / n)
    model.identity_error = float(np.abs(covariance - np.eye(len(values))).max())
    return model


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error, a
    row for each row that takes part and each component."""
    rows = written(integer_rows(vectors, key, column), "whitening-rows")
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.col("size") == (common[0] if common else 0))
    model = fit_whitening(rows, most)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = len(model.values), len(model.sums)
        for batch in _sliced(batches, max(1, BLOCK // max(size, 1))):
            x = _unpacked(batch.column(1).to_pylist(), size)
            many = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(many), k))), pa.array(np.tile(np.arange(1, k + 1), many), pa.int32()),
                pa.array(np.full(many * k, model.n)), pa.array([v for v in model.deviation(x) for _ in range(k)], pa.int64()),
                pa.array(model.whitened(x).reshape(-1)), pa.array(np.tile(model.values / model.trace, many)), pa.array(np.full(many * k, model.identity_error)),
            ], [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(key, "x").mapInArrow(run, schema)
