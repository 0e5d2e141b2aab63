"""Whitening of embeddings by shifted Cholesky QR.

The centred matrix of distinct vectors is never gathered. Each pass adds up its Gram matrix, a d x d sum of partial sums of
the tasks; its Cholesky factor orthogonalises the rows of the next pass by a triangular solve inside the tasks. The first
pass adds a small shift, so that the factor exists however badly the columns are scaled; two more passes restore
orthogonality to rounding. The product of the factors is the R of the matrix, and its singular values and right vectors
are the standard deviations (times sqrt(n)) and components. Only n, sums and d x d matrices reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelkit.session import pinned

STEP, COMPONENTS, PASSES = 256, 4, 3
#: Variances below this share of the largest are rounding: their components have no whitened value.
NOTHING = 1e-24
_SAFE = 1 << 62


@dataclass
class Whitening:
    """n and per-dimension sums of the fit list, components (rows), their variances, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def values(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN where a component has no variance."""
        with np.errstate(invalid="ignore", divide="ignore"):
            scale = np.where(self.variances > 0, np.sqrt(self.variances), np.nan)
            return centred(x, self.n, self.sums) @ self.components.T / scale


def grid(df: DataFrame, vector: str = "embedding", step: int = STEP) -> DataFrame:
    """The table with a column ``x`` of long integers, floor(step * entry), without the rows that can't have one.

    Rows go whose vector is null or holds a null or a non-finite entry, and those with another number of entries than
    most rows have (of equally frequent numbers, than the largest).
    """
    entry = F.col(vector)
    odd = F.exists(entry, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(entry.isNotNull() & ~odd).withColumn("x", F.transform(entry, lambda c: F.floor(F.lit(float(step)) * c.cast("double"))))
    most = rows.groupBy(F.size("x").alias("d")).count().agg(F.max_by("d", F.struct("count", "d"))).first()[0]
    return rows.where(F.size("x") == (most or 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _times(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit integers where all fit, else Python's."""
    most = max([abs(int(x.max())), abs(int(x.min()))]) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < _SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, rounded once."""
    return _times(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - sums) squared, exactly."""
    t = _times(x, n, sums)
    if t.dtype != object and (not t.size or float(np.abs(t).max()) ** 2 * t.shape[1] < _SAFE):
        return (t * t).sum(1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in t]


def solved(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x times the inverse of the upper triangular ``r``, by substitution over the columns."""
    out = np.empty_like(x)
    for j in range(r.shape[0]):
        out[:, j] = (x[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Count and exact sums of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                safe = max(abs(int(x.max())), abs(int(x.min()))) * len(x) < _SAFE if x.size else True
                part = (x if safe else x.astype(object)).sum(0).astype(object)
                n, sums = n + len(x), part if sums is None else sums + part
        if n:
            values = [Decimal(n), *(Decimal(int(v)) for v in sums)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["place", "value"])

    parts = fit.select("x").mapInArrow(run, "place int, value decimal(38,0)")
    found = [int(r[1]) for r in parts.groupBy("place").agg(F.sum("value").cast("decimal(38,0)").alias("value")).orderBy("place").collect()]
    return (found[0], found[1:]) if found else (0, [])


def _gram(fit: DataFrame, turn) -> np.ndarray:
    """Sum over rows of the outer product of ``turn(x)`` with itself: tasks add up theirs, then Spark adds by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = turn(_matrix(batch.column(0)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None and total.size:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int64)), pa.array(total.ravel())], ["place", "value"])

    parts = fit.select("x").mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(parts.num_rows)
    out[parts.column("place").to_numpy()] = parts.column("value").to_numpy()
    side = round(len(out) ** 0.5)
    return out.reshape(side, side)


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor, with a growing shift where rounding or a missing rank leaves the matrix without one."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 1e-15 * float(np.trace(gram)), 1e-300)


def fitted(fit: DataFrame, components: int = COMPONENTS, passes: int = PASSES) -> Whitening | None:
    """The whitening of a table whose column ``x`` holds each distinct vector once; None for an empty table."""
    n, sums = _totals(fit)
    if not n:
        return None
    d, r = len(sums), None
    factors: list[np.ndarray] = []

    def rows(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums)
        for f in factors:
            y = solved(y, f)
        return y

    trace = 0.0
    for k in range(passes if d else 0):
        gram = _gram(fit, rows)
        if k == 0:
            trace = float(np.trace(gram)) / n
            # the shift of the published method, 11 (n d + d (d + 1)) u |X|^2, with the trace for the squared norm
            shift = 11 * (n * d + d * (d + 1)) * 2.0**-53 * float(np.trace(gram))
        f = _factor(gram, shift if k == 0 else 0.0)
        factors = [*factors, f]
        r = f if r is None else f @ r
    if not trace:
        return Whitening(n, sums, np.eye(d)[:components], np.zeros(min(components, d)), 0.0)
    _, s, right = np.linalg.svd(r)
    e, right = s[:components] ** 2 / n, right[:components]
    right = right * np.sign(right[np.arange(len(right)), np.abs(right).argmax(1)])[:, None]
    return Whitening(n, sums, right, np.where(e > NOTHING * e[0], e, 0.0), trace)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the fit list's whitened values minus the identity, over components that have values."""
    live = model.variances > 0
    if not live.any():
        return 0.0
    gram = _gram(fit, lambda x: model.values(x)[:, live])
    return float(np.abs(gram / model.n - np.eye(len(gram))).max())


def whitened(df: DataFrame, id_: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Which rows take part is told by ``grid``. Each distinct vector counts once in the fit, and every row that takes part
    has rows in the result, copies and null ids too. With fewer dimensions than ``components`` there are as many
    components as dimensions. A component without variance (equal vectors, a single vector, a missing rank) has explained
    0 and a null whitened value and is left out of identity_error. deviation is a decimal, null beyond 38 digits. No other
    column of the table is read or returned, so names can't clash. An empty table, or one without usable rows, gives no rows.
    """
    out = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = pinned(grid(df.select(F.col(id_).alias("id"), F.col(vector).alias("vector")), "vector").select("id", "x"), "grid")
    fit = pinned(rows.select("x").distinct(), "fit")
    model = fitted(fit, components)
    kind = rows.schema["id"].dataType.simpleString()
    names = f"{id_} {kind}, {out}"
    if model is None:
        return df.sparkSession.createDataFrame([], names)
    error = identity_error(fit, model)
    shares = (model.variances / model.trace if model.trace else model.variances).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1)) if batch.num_rows else np.zeros((0, len(model.sums)), np.int64)
            m, k = len(x), len(shares)
            dev = pa.array([Decimal(v) if v < 10**38 else None for v in deviations(x, model.n, model.sums)], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [
                batch.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)),
                dev.take(each),
                pa.array(model.values(x).ravel(), from_pandas=True),
                pa.array(np.tile(shares, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, names)
