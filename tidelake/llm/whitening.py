"""Whitening of vectors from the singular values of the centred rows, never from a covariance.

Entries are made integers, ``floor(scale * c) + offset``, so that their sums are exact and rows are
centred without loss, whatever the offset. Tasks take blocks of centred rows and keep R of their QR
factorisation, whose size does not depend on the rows; the Rs are merged in a tree. The driver makes
the last R bidiagonal, finds its singular values by dqds and the directions by twisted
factorisations (``bidiagonal.py``), and tasks project the rows.

The vectors are written once and read by each pass; nothing is shuffled but one state per task.

Nulls and edge cases: a vector that is null, or has a null or non-finite entry, takes no part; so
does one of another length than the most frequent (of equally frequent ones the longest), and one
with an entry that is no long as an integer. Null ids are carried through; repeated rows take part
each for itself. A direction without variance (below the rounding of the largest one) has whitened
null and explained 0, and is left out of the identity error; it is null if there is none.
A deviation that is no long is null. An empty table gives an empty result. Columns other than the id
and the vector are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.lake import stage
from tidelake.llm.bidiagonal import EPS, right_vectors
from tidelake.llm.trees import merged_state

#: Entries of the vectors that a task works on at a time.
BLOCK = 1 << 20
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What is known of all rows: their number, the sums of each dimension, and the directions.

    ``values`` are the variances of the directions, ``trace`` is that of all dimensions.
    """

    scale: int
    offset: int
    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float

    def integers(self, vectors: np.ndarray) -> np.ndarray:
        return integers(vectors, self.scale, self.offset)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        return _shifted(x, self.n, self.sums)

    def project(self, shifted: np.ndarray) -> np.ndarray:
        """Whitened rows, for the directions with variance."""
        some = self.values > 0
        centred = shifted.astype(float) / self.n
        return centred @ self.directions[:, some] / np.sqrt(self.values[some])


def integers(vectors: np.ndarray, scale: int, offset: int) -> np.ndarray:
    return np.floor(scale * vectors.astype(float)).astype(np.int64) + offset


def _shifted(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    most = int(np.abs(x).max(initial=0))
    if n * most <= LONG // 2 and max(map(abs, sums), default=0) <= LONG // 2:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squares(shifted: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row, exact; null beyond a long."""
    d = shifted.shape[1]
    most = int(np.abs(shifted).max()) if shifted.size else 0
    if most * most * d <= LONG:
        return (shifted.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = (shifted.astype(object) ** 2).sum(axis=1).tolist()
    return [v if v <= LONG else None for v in found]


def usable(vector: Column, scale: int, offset: int) -> Column:
    """Whether a vector is there and all its entries are finite and longs as integers."""
    far = F.lit(float(1 << 62))

    def good(c: Column) -> Column:
        value = c.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value * scale) + abs(offset) < far)

    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, good)


def usable_rows(
    df: DataFrame, scale: int, offset: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The rows that take part, as ``row`` (the id) and ``v``, written once."""
    rows = stage(
        df.select(F.col(id_col).alias("row"), F.col(vector_col).alias("v")).filter(
            usable(F.col("v"), scale, offset)
        )
    )
    sizes = rows.groupBy(F.size("v").alias("d")).count()
    usual = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == usual.d) if usual else rows


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of the rows, not many entries at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, column = batch.column("row"), batch.column("v")
        d = len(column[0])
        vectors = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        step = max(1, BLOCK // d)
        for i in range(0, len(vectors), step):
            yield ids.slice(i, step), vectors[i : i + step]


def _sums(rows: DataFrame, scale: int, offset: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension, exact."""

    def merge(states: list[bytes]) -> bytes:
        counts, sums = zip(*map(pickle.loads, states))
        return pickle.dumps((sum(counts), [sum(own) for own in zip(*sums)]))

    def summarise(batches: Iterable[pa.RecordBatch]) -> bytes | None:
        state = None
        for _, vectors in blocks(batches):
            x = integers(vectors, scale, offset)
            wide = int(np.abs(x).max()) * len(x) > LONG
            own = pickle.dumps((len(x), (x.astype(object) if wide else x).sum(axis=0).tolist()))
            state = merge([state, own]) if state else own
        return state

    state = merged_state(rows.select("row", "v"), summarise, merge)
    return pickle.loads(state) if state else (0, [])


def _triangle(rows: DataFrame, scale: int, offset: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows, square."""
    d = len(sums)

    def reduced(parts: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack(parts), mode="r")

    def merge(states: list[bytes]) -> bytes:
        return reduced([np.frombuffer(s).reshape(-1, d) for s in states]).tobytes()

    def summarise(batches: Iterable[pa.RecordBatch]) -> bytes | None:
        r = np.zeros((0, d))
        for _, vectors in blocks(batches):
            shifted = _shifted(integers(vectors, scale, offset), n, sums)
            r = reduced([r, shifted.astype(float) / n])
        return r.tobytes() if len(r) else None

    r = np.frombuffer(merged_state(rows.select("row", "v"), summarise, merge)).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def fit_whitening(rows: DataFrame, scale: int, offset: int, most: int) -> Whitening | None:
    """Fit on all ``usable_rows``; None if there are none."""
    n, sums = _sums(rows, scale, offset)
    if not n:
        return None
    roots, directions = right_vectors(_triangle(rows, scale, offset, n, sums), most)
    variance = roots**2 / n
    # What is below the rounding of the factorisation is no variance.
    least = (roots[0] * 8 * EPS * len(roots)) ** 2 / n
    values = np.where(variance > least, variance, 0.0)[:most]
    return Whitening(scale, offset, n, sums, directions, values, float(variance.sum()))


def identity_error(rows: DataFrame, fit: Whitening) -> float | None:
    """The largest absolute entry of the covariance of the whitened rows less the identity."""
    m = int((fit.values > 0).sum())
    if not m:
        return None

    def merge(states: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(s) for s in states], axis=0).tobytes()

    def summarise(batches: Iterable[pa.RecordBatch]) -> bytes | None:
        total = None
        for _, vectors in blocks(batches):
            w = fit.project(fit.deviations(fit.integers(vectors)))
            own = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
            total = own if total is None else total + own
        return None if total is None else total.tobytes()

    total = np.frombuffer(merged_state(rows.select("row", "v"), summarise, merge)) / fit.n
    mean, moments = total[:m], total[m:].reshape(m, m)
    return float(np.abs(moments - np.outer(mean, mean) - np.eye(m)).max())


def whiten(
    df: DataFrame, scale: int = 1024, offset: int = 100_000, components: int = 8,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per row that takes part and direction: the id, component (from 1, by falling
    variance), n, deviation, whitened, explained, identity_error.
    """
    rows = usable_rows(df, scale, offset, id_col, vector_col)
    kind = rows.schema["row"].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double,"
        " explained double, identity_error double"
    )
    fit = fit_whitening(rows, scale, offset, components)
    if fit is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, fit)
    shared = df.sparkSession.sparkContext.broadcast(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        m = len(fit.values)
        explained = fit.values / fit.trace if fit.trace else np.zeros(m)
        some = np.flatnonzero(fit.values > 0)
        for ids, vectors in blocks(batches):
            size = len(ids)
            shifted = fit.deviations(fit.integers(vectors))
            whitened = np.full((size, m), np.nan)
            whitened[:, some] = fit.project(shifted)
            each = np.repeat(np.arange(size), m)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * m, fit.n)),
                    pa.array(squares(shifted), pa.int64()).take(pa.array(each)),
                    pa.array(whitened.ravel(), mask=np.isnan(whitened.ravel())),
                    pa.array(np.tile(explained, size)),
                    pa.array([error] * (size * m), pa.float64()),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("row", "v").mapInArrow(run, schema)
