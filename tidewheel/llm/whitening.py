"""Whitening of embeddings: moments summed by Spark, components by pivoted Cholesky and one-sided Jacobi.

Vectors are put on a grid of integers, so equal ones are found and sums are exact.  Tasks sum what is centred at the mean
already; what reaches the driver is the scatter of the dimensions, however many vectors there are.  There it is
factorised with pivoting, and Jacobi rotations make the columns of the triangular factor orthogonal: their squared norms
are the eigenvalues and the normalised columns the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded_batches, claim, saved

#: Steps of the grid per unit, and components returned.
GRID, COMPONENTS = 256, 4
#: Grid numbers end here on both sides, so that 10,000 of them sum up without overflow.
LIMIT = 1 << 40
_BATCH = 10_000


@dataclass
class Whitening:
    """``n`` fitted vectors with exact sums, unit components as columns, their variances and the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.variances)


def quantised(vectors: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of some vectors take part (``d`` finite entries), and their grid numbers ``floor(256 c)``, (m, d) long."""
    stops = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
    at = np.flatnonzero((np.diff(stops) == d) & vectors.is_valid().to_numpy(zero_copy_only=False))
    x = values[stops[at][:, None] + np.arange(d)]
    whole = np.isfinite(x).all(axis=1)
    # beyond the limit the product may overflow to infinity, which is cut to the limit as well
    with np.errstate(over="ignore"):
        return at[whole], np.clip(np.floor(x[whole] * GRID), -LIMIT, LIMIT).astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """A row's bytes: two per number where that holds them, else eight."""
    short = np.abs(x).max(axis=1, initial=0) < 1 << 15
    return [row.astype("<i2").tobytes() if s else row.astype("<i8").tobytes() for row, s in zip(x, short.tolist())]


def _unpacked(rows: pa.Array, d: int) -> np.ndarray:
    held = rows.to_pylist()
    short = np.array([len(r) == 2 * d for r in held], bool)
    out = np.zeros((len(held), d), np.int64)
    for kind, mask in (("<i2", short), ("<i8", ~short)):
        out[mask] = np.frombuffer(b"".join(r for r, m in zip(held, mask.tolist()) if m), kind).reshape(-1, d)
    return out


def dimension(vectors: DataFrame, vector: str) -> int:
    """The most frequent length (the longer on ties), 0 for an empty table: vectors of another length take no part."""
    sizes = vectors.where(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def _summed(fit: DataFrame, d: int, work: Callable[[np.ndarray], np.ndarray], kind: str, every: bool) -> np.ndarray:
    """Entry by entry, the sum of what ``work`` makes of blocks of fitted vectors.

    ``every`` block is sent on by itself where sums must stay exact; else a task adds its own blocks up.
    """
    number = "decimal(38,0)" if kind == "long" else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                made = work(_unpacked(batch.column(0).slice(at, _BATCH), d)).ravel()
                if every:
                    yield pa.RecordBatch.from_arrays([pa.array([made.tolist()])], ["part"])
                else:
                    held = made if held is None else held + made
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tolist()])], ["part"])

    parts = fit.select("x").mapInArrow(run, f"part array<{kind}>").select(F.posexplode("part").alias("at", "v"))
    rows = parts.groupBy("at").agg(F.sum(F.col("v").cast(number)).alias("v")).orderBy("at").toArrow()
    return rows["v"].to_pylist()


def _scatter(fit: DataFrame, d: int, project: Callable[[np.ndarray], np.ndarray], centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of deviations from ``centre`` and of their products, over all fitted vectors."""
    m = len(centre)

    def work(x: np.ndarray) -> np.ndarray:
        away = project(x) - centre
        return np.vstack([away.sum(axis=0), away.T @ away])

    total = np.array(_summed(fit, d, work, "double", every=False)).reshape(m + 1, m)
    return total[0], total[1:]


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``g`` with ``g @ g.T`` equal to ``a``, one column per rank; lower triangular once its rows are put in pivot order."""
    left = a.astype(float).copy()
    columns, d = [], len(a)
    floor = d * np.finfo(float).eps * max(0.0, left.diagonal().max(initial=0.0))
    for _ in range(d):
        p = int(left.diagonal().argmax())
        if left[p, p] <= floor:
            break
        column = left[:, p] / np.sqrt(left[p, p])
        left -= np.outer(column, column)
        # done rows hold nothing but rounding
        left[p, :] = left[:, p] = 0.0
        columns.append(column)
        for row in [q for q in range(d) if left[q, q] < 0]:
            left[row, :] = left[:, row] = 0.0
    return np.stack(columns, axis=1) if columns else np.zeros((d, 0))


def _rounds(m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``m`` columns once, as rounds of pairs that have no column in common."""
    n = m + m % 2
    seats = np.arange(n)
    for _ in range(n - 1):
        p, q = seats[: n // 2], seats[n // 2 :][::-1]
        real = (p < m) & (q < m)
        yield p[real], q[real]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of ``g @ g.T``: columns are rotated until all are orthogonal."""
    g = g.copy()
    for _ in range(sweeps):
        rotated = False
        for p, q in _rounds(g.shape[1]):
            x, y = g[:, p], g[:, q]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(c) > 1e-15 * np.sqrt(a * b)
            if not turn.any():
                continue
            rotated = True
            zeta = np.divide(b - a, 2 * c, out=np.zeros_like(c), where=turn)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = np.where(turn, 1 / np.hypot(1.0, t), 1.0)
            sin = np.where(turn, cos * t, 0.0)
            g[:, p], g[:, q] = cos * x - sin * y, sin * x + cos * y
        if not rotated:
            break
    norms = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def fit(vectors: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """Learn from each distinct grid vector once; None where no vector takes part."""
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(vector).cast("array<double>").alias("v"))
    d = dimension(rows, "v")
    if not d:
        return None

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_packed(quantised(batch.column(0), d)[1]), pa.binary())], ["x"])

    distinct = saved(rows.mapInArrow(grid, "x binary").distinct(), "fit")
    sums = [int(s) for s in _summed(distinct, d, lambda x: np.vstack([np.ones((1, d), np.int64) * len(x), x.sum(axis=0)]), "long", every=True)]
    if not sums:
        return None
    model = Whitening(sums[0], sums[d:], np.zeros((d, 0)), np.zeros(0), 0.0)
    mean = model.mean
    off, products = _scatter(distinct, d, lambda x: x.astype(float), mean)
    scatter = products - np.outer(off, off) / model.n  # the mean is rounded: what that leaves
    scatter = (scatter + scatter.T) / 2
    squares, axes = jacobi(pivoted_cholesky(scatter))
    model.variances, model.components = squares[:most] / model.n, axes[:, :most]
    model.trace = float(np.trace(scatter)) / model.n
    if len(model.variances):
        centre = _scatter(distinct, d, model.apply, np.zeros(len(model.variances)))[0] / model.n
        covariance = _scatter(distinct, d, model.apply, centre)[1] / model.n
        model.identity_error = float(np.abs(covariance - np.eye(len(centre))).max())
    return model


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of ``(n x - S) ** 2``, exact: arithmetic modulo 2 ** 64 is, where the result is a long; else null."""
    wrapped = np.array([s & (1 << 64) - 1 for s in sums], np.uint64).view(np.int64)
    about = ((float(n) * x - np.array(sums, float)) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):
        away = np.int64(n) * x - wrapped
        exact = (away * away).sum(axis=1)
    return pa.array(exact, mask=about > 9.2e18)


def whiten(vectors: DataFrame, model: Whitening | None, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows of ``vectors`` that take part, once per component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.

    Null vectors, those with null or non-finite entries and those whose length is not the most frequent one take no part.
    Repeated rows and rows without id are rows like any other.  A direction without variance is no component: one vector,
    or copies of one, give no rows, as an empty table does.  Grid numbers end at 2 ** 40 either way.  A deviation too large
    for a long is null.  Other columns aren't read.
    """
    bounded_batches(vectors.sparkSession)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim()
        for batch in batches:
            if model is None or not len(model.variances):
                continue
            at, x = quantised(batch.column(1), len(model.sums))
            m, rows = len(model.variances), np.repeat(np.arange(len(at)), len(model.variances))
            columns = [
                batch.column(0).take(pa.array(at)).take(pa.array(rows)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(rows), model.n)), _deviation(x, model.n, model.sums).take(pa.array(rows)),
                pa.array(model.apply(x).ravel()), pa.array(np.tile(model.variances / model.trace, len(at))),
                pa.array(np.full(len(rows), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kinds = ("long", "int", "long", "long", "double", "double", "double")
    return rows.mapInArrow(run, ", ".join(map(" ".join, zip(names, kinds))))
