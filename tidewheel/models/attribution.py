"""How much each feature adds to a boosted model's prediction for a row, so that the parts add up.

A tree alone is a sum over its leaves.  A leaf counts for a set of known features as the product, over the features on its
path, of 1 or 0 where the feature is known (does the row stay on the path?) and of the share of training weight that stays
on it where it is not.  The Shapley value of such a product is an integral of a polynomial over [0, 1], which Gauss-Legendre
points give exactly, for all rows of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.models.boosting import Boosted, Tree, _matrix


@dataclass
class Path:
    """A leaf and, for each feature on the way, its share of the weight and the conditions ``(cut, null goes on, left)``."""

    value: float
    shares: dict[int, float]
    conditions: dict[int, list[tuple[float, bool, bool]]]


def paths(tree: Tree) -> list[Path]:
    out: list[Path] = []
    todo: list[tuple[int, dict, dict]] = [(0, {}, {})]
    while todo:
        node, shares, conditions = todo.pop()
        f = tree.feature[node]
        if f < 0:
            out.append(Path(tree.value[node], shares, conditions))
            continue
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            share = tree.cover[child] / tree.cover[node] if tree.cover[node] > 0 else 0.5
            step = (tree.cut[node], tree.null_left[node] == left, left)
            todo.append((child, {**shares, f: shares.get(f, 1.0) * share}, {**conditions, f: [*conditions.get(f, []), step]}))
    return out


def _stays(x: np.ndarray, conditions: list[tuple[float, bool, bool]]) -> np.ndarray:
    out = np.ones(len(x), bool)
    missing = np.isnan(x)
    for cut, null_on, left in conditions:
        out &= np.where(missing, null_on, (x <= cut) == left)
    return out


def tree_attributions(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, float]:
    """Per row and feature the Shapley value of one tree, and the tree's mean over its training weight."""
    out, mean = np.zeros(x.shape), 0.0
    for path in paths(tree):
        names = list(path.shares)
        z = np.array([path.shares[f] for f in names])
        mean += path.value * float(z.prod())
        if not names:
            continue
        o = np.stack([_stays(x[:, f], path.conditions[f]) for f in names], axis=1).astype(float)
        # products over all other features are polynomials of degree len(names) - 1
        points, weights = np.polynomial.legendre.leggauss(len(names) // 2 + 1)
        for t, w in zip((points + 1) / 2, weights / 2):
            terms = (1 - t) * z + t * o
            before = np.cumprod(np.hstack([np.ones((len(x), 1)), terms[:, :-1]]), axis=1)
            after = np.cumprod(np.hstack([np.ones((len(x), 1)), terms[:, :0:-1]]), axis=1)[:, ::-1]
            part = w * path.value * (o - z) * before * after
            for i, f in enumerate(names):
                out[:, f] += part[:, i]
    return out, mean


def attributions(model: Boosted, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, classes, features)`` and the mean score of each class."""
    out, mean = np.zeros((len(x), model.classes, x.shape[1])), np.full(model.classes, model.start)
    for group in model.trees:
        for k, tree in enumerate(group):
            part, own = tree_attributions(tree, x)
            out[:, k] += part
            mean[k] += own
    return out, mean


def explain(model: Boosted, df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``class``, ``feature``, ``attribution``, ``score`` and ``mean_score``: a row per row, class and feature.

    ``score`` is the model's raw one (for a number: the prediction), and the attributions of a row and class add up to
    ``score - mean_score``.  Null features are missing values; repeated rows are explained each for itself.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # at most rounds x classes x 2 ** depth nodes

    @F.pandas_udf("array<struct<class:int,mean_score:double,score:double,parts:array<double>>>")
    def parts(*columns: pd.Series) -> pd.Series:
        x = _matrix(columns)
        values, mean = attributions(sent.value, x)
        raw = sent.value.raw(x)
        return pd.Series([
            [{"class": k, "mean_score": mean[k], "score": raw[i, k], "parts": values[i, k].tolist()} for k in range(len(mean))]
            for i in range(len(x))
        ])

    held = df.select(*keys, parts(*(F.col(f).cast("double") for f in model.features)).alias("_all")).select(*keys, F.inline("_all"))
    named = F.array(*(F.struct(F.lit(f).alias("feature"), F.get("parts", F.lit(i)).alias("attribution")) for i, f in enumerate(model.features)))
    return held.select(*keys, "class", "mean_score", "score", F.inline(named)).select(*keys, "class", "feature", "attribution", "score", "mean_score")


def mean_attributions(explained: DataFrame) -> DataFrame:
    """``feature, mean_abs``: mean size of a feature's attributions, summed over classes as shares of all rows."""
    n = F.count_if(F.col("class") == 0)
    return explained.groupBy("feature").agg((F.sum(F.abs("attribution")) / n).alias("mean_abs"))
