"""Linear models of many targets and many parts of the data from one pass of moments.

The sums of all products of inputs and targets say everything about least squares.  They are added up by part (a fold, a
series), map side first; parts are merged by adding them, so expanding folds are prefix sums and every target is solved
from the same matrix.  Sums are taken around a centre near the data, which keeps large means from swallowing the
differences.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Sums of products of ``(1, inputs - centre, targets - centre)``, a square matrix; ``width`` inputs come first."""

    centre: np.ndarray
    sums: np.ndarray
    width: int

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.centre, self.sums + other.sums, self.width)

    @property
    def n(self) -> int:
        return round(self.sums[0, 0])

    def solve(self, ridge: float = 0.0) -> Linear:
        """Least squares with an intercept; ``ridge`` is added to the inputs' variances, in units of each.

        An input without variance, or one that others determine, gets the smallest coefficients that fit.
        """
        n, d = self.sums[0, 0], self.width
        if n == 0:
            return Linear(np.zeros((d, len(self.centre) - d)), np.full(len(self.centre) - d, np.nan))
        mean = self.sums[0, 1:] / n
        spread = self.sums[1:, 1:] - n * np.outer(mean, mean)
        scale = np.sqrt(np.maximum(spread.diagonal()[:d], 0))
        scale[scale <= 1e-12 * np.sqrt(n) * (1 + np.abs(self.centre[:d]))] = 0
        unit = np.divide(1.0, scale, out=np.zeros(d), where=scale > 0)
        a = spread[:d, :d] * unit[:, None] * unit + ridge * np.eye(d)
        b = spread[:d, d:] * unit[:, None]
        weights = np.linalg.lstsq(a, b, rcond=1e-12)[0] * unit[:, None]
        level = self.centre + mean
        return Linear(weights, level[d:] - level[:d] @ weights)

    def errors(self, model: Linear) -> np.ndarray:
        """Sum of squared errors of a model, per target, on the rows of these moments."""
        d = self.width
        # an error is a linear form of (1, inputs, targets)
        form = np.zeros((len(self.sums), len(self.centre) - d))
        form[0] = self.centre[d:] - self.centre[:d] @ model.weights - model.intercepts
        form[1 : d + 1] = -model.weights
        form[d + 1 :] = np.eye(form.shape[1])
        return np.maximum(0.0, np.einsum("it,ij,jt->t", form, self.sums, form))

    def spread(self) -> np.ndarray:
        """Sum of squared deviations of each target from its mean."""
        n, d = max(self.sums[0, 0], 1.0), self.width
        return self.sums.diagonal()[d + 1 :] - self.sums[0, d + 1 :] ** 2 / n


@dataclass
class Linear:
    """``weights`` (inputs x targets) and ``intercepts``."""

    weights: np.ndarray
    intercepts: np.ndarray

    def apply(self, inputs: Column) -> Column:
        """Array of predictions, one per target, as an expression on an array of inputs."""

        def one(weights: list[float], intercept: float) -> Column:
            terms = F.zip_with(inputs, F.lit(weights), lambda x, w: x * w)
            return F.aggregate(terms, F.lit(intercept), lambda a, v: a + v)

        return F.array(*(one(w.tolist(), float(b)) for w, b in zip(self.weights.T, self.intercepts)))


def moments(df: DataFrame, inputs: str, targets: str, part: str | None = None) -> dict[object, Moments]:
    """Moments by ``part`` (null and none: one part) of two array columns; rows with a null entry take no part.

    A task sends one matrix per part it has seen, and these are added entry by entry before they reach the driver.
    """
    rows = df.select(
        (F.col(part) if part else F.lit(0)).cast("int").alias("part"), F.col(inputs).cast("array<double>").alias("x"), F.col(targets).cast("array<double>").alias("y"),
    ).where("x IS NOT NULL AND y IS NOT NULL AND NOT exists(x, v -> v IS NULL) AND NOT exists(y, v -> v IS NULL)")
    first = rows.first()
    if first is None:
        return {}
    d, t = len(first["x"]), len(first["y"])
    both, m = F.concat("x", "y"), d + t + 1
    # any row near the data will do as the centre
    centre = np.array([*first["x"], *first["y"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int | None, np.ndarray] = {}
        for batch in batches:
            z = np.hstack([np.ones((batch.num_rows, 1)), batch.column(1).flatten().to_numpy().reshape(-1, m - 1) - centre])
            codes = np.array([-1 if p is None else p for p in batch.column(0).to_pylist()])
            for p in np.unique(codes).tolist():
                own = z[codes == p]
                held[p] = held.get(p, 0) + own.T @ own
        for p, sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([sums.ravel().tolist()])], ["part", "sums"])

    sums = rows.select("part", both.alias("z")).mapInArrow(run, "part long, sums array<double>")
    added = sums.select("part", F.posexplode("sums").alias("at", "v")).groupBy("part", "at").agg(F.sum("v").alias("v"))
    out: dict[object, Moments] = {}
    for r in added.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("s")).collect():
        out[None if r["part"] < 0 else r["part"]] = Moments(centre, np.array([e["v"] for e in r["s"]]).reshape(m, m), d)
    return out


def expanding_fits(df: DataFrame, inputs: Sequence[str], target: str, folds: int, fold: str = "fold", ridge: float = 0.0) -> DataFrame:
    """``fold, test_samples, rmse, r2, intercept, coefficients`` for folds 1..``folds``, each fitted on all before it.

    One pass adds up the folds' moments; training sets are their prefix sums, and errors follow from the moments too.
    """
    ready = df.select(fold, F.array(*inputs).alias("_x"), F.array(target).alias("_y"))
    parts = moments(ready, "_x", "_y", fold)
    rows, before = [], parts.get(0)
    for k in range(1, folds + 1):
        own = parts.get(k)
        if own and before:
            model = before.solve(ridge)
            error, spread = float(own.errors(model)[0]), float(own.spread()[0])
            r2 = 1 - error / spread if spread > 0 else None
            rows.append((k, own.n, (error / own.n) ** 0.5, r2, float(model.intercepts[0]), model.weights[:, 0].tolist()))
        before = own if before is None else before + own if own else before
    kinds = "fold int, test_samples long, rmse double, r2 double, intercept double, coefficients array<double>"
    return df.sparkSession.createDataFrame(rows, kinds)
