"""Whitening of embeddings, fitted by streaming rank-one updates.

Entries become fixed-point numbers x = floor(256 * c). The fit list has each distinct vector
once. Every partition of it runs Welford's update: the mean moves by a vector, the scatter
matrix takes one rank-one term for each vector, centred before it is multiplied. States of
partitions are merged by the parallel formula, first in MERGERS tasks that read them one after
another and then in one, which reads MERGERS states however large the table is; only the
merged state comes to the driver, whose size is that of one matrix. There a symmetric QR
iteration (Householder reduction to three diagonals, then shifted rotations) gives the
eigenvectors of the covariance. Rows are projected in a pass without exchange.

Odd rows: a null vector, one without entries and one with null or non-finite entries give no
rows, nor does one whose length is not the commonest (of equally common ones the smallest).
Repeated rows and ids keep a row for each component; a null id stays null. A component without
variance (a single distinct vector, or fewer vectors than dimensions) has a null `whitened`.
`deviation` is exact and null where 64 bits cannot hold it; floor() holds entries to 64 bits.
An empty table gives no rows. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, forget, written

#: Steps of the fixed-point grid to one, tasks of the first merge, and components of a row at most.
GRID, MERGERS, COMPONENTS = 256, 16, 4
STATE = "n bigint, mean binary, scatter binary, high binary, low binary"


@dataclass
class State:
    """Number of vectors, their mean, the scatter around it, and exact sums in two halves."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray
    high: np.ndarray
    low: np.ndarray

    @classmethod
    def of(cls, d: int) -> State:
        return cls(0, np.zeros(d), np.zeros((d, d)), np.zeros(d, object), np.zeros(d, object))

    def add(self, x: np.ndarray) -> None:
        """Welford's update: the deviation from the old mean times that from the new one."""
        self.n += 1
        delta = x - self.mean
        self.mean += delta / self.n
        self.scatter += np.outer(delta, x - self.mean)

    def merge(self, other: State) -> None:
        n = self.n + other.n
        if not other.n:
            return
        delta = other.mean - self.mean
        self.scatter += other.scatter + np.outer(delta, delta) * (self.n / n * other.n)
        self.mean += delta * (other.n / n)
        self.high, self.low, self.n = self.high + other.high, self.low + other.low, n

    def packed(self) -> pa.RecordBatch:
        # sums are Python integers of any size, as text
        text = lambda a: ",".join(map(str, a)).encode()
        values = [self.n], [self.mean.tobytes()], [self.scatter.tobytes()], [text(self.high)], [text(self.low)]
        kinds = pa.int64(), *[pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["n", "mean", "scatter", "high", "low"])

    @classmethod
    def unpacked(cls, n: int, mean: bytes, scatter: bytes, high: bytes, low: bytes) -> State:
        m = np.frombuffer(mean).copy()
        whole = lambda b: np.array([int(v) for v in b.split(b",") if v], object)
        return cls(n, m, np.frombuffer(scatter).reshape(len(m), len(m)).copy(), whole(high), whole(low))


def matrix_of(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column, all of length d, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def usable(vector: Column) -> Column:
    """Whether a vector has entries, and all are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def fixed_point(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * GRID).cast("bigint"))


def merged(states: DataFrame, d: int) -> State:
    """All states as one, in two rounds of merging."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = State.of(d)
        for batch in batches:
            for r in batch.to_pylist():
                total.merge(State.unpacked(**r))
        if total.n:
            yield total.packed()

    last = states.repartition(MERGERS).mapInArrow(run, STATE).repartition(1).mapInArrow(run, STATE).first()
    return State.of(d) if last is None else State.unpacked(last["n"], *(bytes(last[k]) for k in ("mean", "scatter", "high", "low")))


def scattered(vectors: DataFrame, d: int) -> State:
    """Welford's state over a column `x` of vectors of length d, of long integers or doubles."""
    exact = vectors.schema["x"].dataType.elementType.typeName() == "long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = State.of(d)
        for batch in batches:
            rows = matrix_of(batch.column(0), d)
            for x in rows.astype(np.float64):
                state.add(x)
            if exact and len(rows):
                state.high += (rows >> 32).sum(axis=0).astype(object)
                state.low += (rows & 0xFFFFFFFF).sum(axis=0).astype(object)
        if state.n:
            yield state.packed()

    return merged(arrow_map(vectors.select("x"), run, STATE), d)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, next diagonal, q): q' a q has three diagonals, by Householder reflections."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        if not v[1:].any():
            continue
        v /= np.abs(v).max()  # squares of what rounding leaves may be too small to hold
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        # a symmetric rank-two change does both sides at once
        block = a[k + 1 :, k + 1 :]
        w = block @ v
        w -= (v @ w) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Implicit QR steps with Wilkinson's shift chase a bulge down the unreduced block at the end,
    until each entry beside the diagonal is lost in rounding.
    """
    n = len(a)
    d, e, q = tridiagonal(a)
    columns = np.ascontiguousarray(q.T)  # rows are contiguous
    end, steps = n - 1, 0
    while end > 0:
        small = np.abs(e[:end]) <= np.finfo(float).eps * (np.abs(d[:end]) + np.abs(d[1 : end + 1]))
        e[:end][small] = 0.0
        if e[end - 1] == 0:
            end -= 1
            continue
        steps += 1
        if steps > 60 * n:
            raise ArithmeticError("the QR iteration did not settle")
        cut = np.flatnonzero(e[:end] == 0)
        begin = int(cut[-1]) + 1 if len(cut) else 0
        half = (d[end - 1] - d[end]) / 2
        shift = d[end] - e[end - 1] ** 2 / (half + np.copysign(np.hypot(half, e[end - 1]), half))
        x, z = d[begin] - shift, e[begin]
        for k in range(begin, end):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > begin:
                e[k - 1] = r
            above, below, beside = d[k], d[k + 1], e[k]
            d[k] = c * c * above + 2 * c * s * beside + s * s * below
            d[k + 1] = s * s * above - 2 * c * s * beside + c * c * below
            e[k] = c * s * (below - above) + (c * c - s * s) * beside
            if k < end - 1:
                x, z = e[k], s * e[k + 1]
                e[k + 1] *= c
            u, w = columns[k], columns[k + 1]
            columns[k], columns[k + 1] = c * u + s * w, c * w - s * u
    order = np.argsort(-d, kind="stable")
    return d[order], columns[order].T


@dataclass
class Model:
    """What rows are projected by: the exact sums, and the first components with their variances."""

    d: int
    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(e); nan for components without variance."""
        real = self.values > 1e-13 * max(self.trace, 0.0) * max(self.d, 1)
        return np.where(real, 1 / np.sqrt(np.where(real, self.values, 1.0)), np.nan)

    def projected(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors * self.scales

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2 over the dimensions, exact; None beyond 64 bits."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most * most * self.d < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        wide = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in wide]


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """The model of all usable vectors; None if there are none."""
    good = vectors.select(F.col(vector).alias("v")).where(usable(F.col("v")))
    held = written(good.select(fixed_point(F.col("v")).alias("x")).groupBy("x").agg(F.count("*").alias("copies")))
    sizes = held.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), "d").first()
    if sizes is None:
        forget(held)
        return None
    d = sizes["d"]
    listed = held.where(F.size("x") == d)
    state = scattered(listed, d)
    values, axes = symmetric_qr(state.scatter / state.n)
    values, axes, k = np.maximum(values, 0.0), axes, min(components, d)
    sums = [int(h) * (1 << 32) + int(low) for h, low in zip(state.high, state.low, strict=True)]
    mean = np.array([s / state.n for s in sums])  # rounded once, unlike the mean that moved
    model = Model(d, state.n, sums, mean, values[:k], axes[:, :k].copy(), float(np.trace(state.scatter) / state.n))
    real = np.isfinite(model.scales)
    if real.any():

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = model.projected(matrix_of(batch.column(0), d).astype(np.float64))[:, real]
                flat = pa.array(np.ascontiguousarray(got).ravel())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.arange(len(got) + 1, dtype=np.int32) * got.shape[1], flat)], names=["x"])

        white = scattered(arrow_map(listed.select("x"), run, "x array<double>"), int(real.sum()))
        model.identity_error = float(np.abs(white.scatter / white.n - np.eye(len(white.mean))).max())
    forget(held)
    return model


def whitened(vectors: DataFrame, model: Model | None, name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: (name, component, n, deviation, whitened,
    explained, identity_error), with the model's figures on each row."""
    key = vectors.schema[name].dataType.simpleString()
    ddl = f"`{name}` {key}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], ddl)
    rows = vectors.select(F.col(name).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v")) & (F.size("v") == model.d)).select("id", fixed_point(F.col("v")).alias("x"))
    k = len(model.values)
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column(1), model.d)
            m = len(x)
            took = np.repeat(np.arange(m), k)
            white = model.projected(x.astype(np.float64)).ravel()
            exact = pa.array(model.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(took)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    exact.take(pa.array(took)),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(explained * m, pa.float64()),
                    pa.array([model.identity_error] * (m * k), pa.float64()),
                ],
                names=[name, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return arrow_map(rows, run, ddl)
