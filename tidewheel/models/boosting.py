"""Gradient-boosted trees for several classes or a number, in one fit.

Training rows become blocks of small bin numbers.  One job per level of a round sums gradients and hessians by class, node,
feature and bin, map side first; the driver sees sums only and picks the splits.  Trees of all classes grow in the same
jobs.  Splits are regularised, a null goes to the side where it gains more, and boosting stops when the loss on held-out
rows has not fallen for some rounds.

A worker remembers the scores of a block after the trees it has seen; where it doesn't know them (a new worker, a lost
executor) it works them out from the trees.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.session import run_dir

#: Rows of a block; a partition has one.
BLOCK_ROWS = 1 << 16
#: Blocks whose scores a worker remembers.
REMEMBERED = 32
_scores: OrderedDict = OrderedDict()


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    rate: float = 0.1
    depth: int = 5
    bins: int = 128
    row_share: float = 0.8
    feature_share: float = 1.0
    least_hessian: float = 1.0
    l2: float = 1.0
    l1: float = 0.0
    least_gain: float = 0.0
    patience: int = 20
    tolerance: float = 1e-3
    seed: int = 42


@dataclass
class Tree:
    """Nodes as columns; a leaf has feature -1.  Known values up to ``cut`` go left, nulls where ``null_left`` says."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    null_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for column, v in zip(vars(self).values(), (-1, 0, 0.0, False, 0, 0, value, cover)):
            column.append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, bin_: int, cut: float, null_left: bool, left: int, right: int) -> None:
        self.feature[node], self.bin[node], self.cut[node], self.null_left[node] = feature, bin_, cut, null_left
        self.left[node], self.right[node] = left, right

    def leaves_of(self, x: np.ndarray, binned: bool = False) -> np.ndarray:
        """Leaf of each row; ``x`` holds bin numbers (missing: the highest number of its type) or values (missing: nan)."""
        feature, left, right, null_left = (np.array(c) for c in (self.feature, self.left, self.right, self.null_left))
        limit = np.array(self.bin if binned else self.cut)
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return at
            v = x[rows, np.maximum(feature[at], 0)]
            missing = v == np.iinfo(x.dtype).max if binned else np.isnan(v)
            goes_left = np.where(missing, null_left[at], v <= limit[at])
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)


@dataclass
class Boosted:
    """A fitted model: ``trees[round][class]``, with one class (and the mean as start) for numbers."""

    features: list[str]
    classes: int
    start: float
    trees: list[list[Tree]]
    losses: list[float]

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full((len(x), self.classes), self.start)
        for group in self.trees:
            for k, tree in enumerate(group):
                out[:, k] += np.array(tree.value)[tree.leaves_of(x)]
        return out

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """Adds the predicted class (or number) and, for classes, the array of their probabilities."""
        model = df.sparkSession.sparkContext.broadcast(self)  # at most rounds x classes x 2 ** depth nodes

        @F.pandas_udf("array<double>")
        def scores(*columns: pd.Series) -> pd.Series:
            raw = model.value.raw(_matrix(columns))
            return pd.Series(list(softmax(raw) if model.value.classes > 1 else raw))

        scored = df.withColumn(probability, scores(*(F.col(c).cast("double") for c in self.features)))
        if self.classes == 1:
            return scored.withColumn(prediction, F.get(probability, F.lit(0))).drop(probability)
        return scored.withColumn(prediction, (F.array_position(probability, F.array_max(probability)) - 1).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        trees = [[vars(t) for t in group] for group in self.trees]
        text = json.dumps({"features": self.features, "classes": self.classes, "start": self.start, "losses": self.losses, "trees": trees})
        spark.createDataFrame([(text,)], "value string").write.text(path)


def load(spark: SparkSession, path: str) -> Boosted:
    held = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    trees = [[Tree(**t) for t in group] for group in held.pop("trees")]
    return Boosted(trees=trees, **held)


def _matrix(columns: Sequence[pd.Series]) -> np.ndarray:
    return np.stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns], axis=1)


def softmax(raw: np.ndarray) -> np.ndarray:
    grown = np.exp(raw - raw.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Up to ``bins - 1`` values of each feature that cut it, its largest among them, from one pass of mergeable sketches."""
    probs = [i / (bins - 2) for i in range(bins - 1)]
    wide = df.agg(*(F.percentile_approx(F.col(f).cast("double"), probs, 20 * bins).alias(f"_{i}") for i, f in enumerate(features))).first()
    return [np.unique([v for v in found or [] if v == v]) for found in wide]


@dataclass(frozen=True)
class Block:
    number: int
    bins: np.ndarray
    y: np.ndarray
    held: np.ndarray


def _blocks(df: DataFrame, features: Sequence[str], label: str, held: str | None, edges: list[np.ndarray], bins: int):
    """Cached blocks of binned rows, made again from a written table where they are lost."""
    kind = np.dtype(np.uint8 if bins < 256 else np.uint16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]
            x = np.empty((batch.num_rows, len(edges)), kind)
            for f, (column, cuts) in enumerate(zip(columns, edges)):
                x[:, f] = np.where(np.isnan(column), np.iinfo(kind).max, np.searchsorted(cuts, column))
            parts = [x.tobytes(), columns[-2].tobytes(), (columns[-1] > 0).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["x", "y", "held"])

    spark = df.sparkSession
    rows = df.select(
        *(F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)), F.col(label).cast("double").alias("y"),
        (F.col(held) if held else F.lit(False)).cast("double").alias("held"),
    )
    rows = rows.repartition(max(1, -(-rows.count() // BLOCK_ROWS)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BLOCK_ROWS)
    try:
        path = run_dir(spark, "binned")
        rows.mapInArrow(run, "x binary, y binary, held binary").write.parquet(path)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    written = spark.read.schema("x binary, y binary, held binary").parquet(path)
    n, width = max(1, written.count()), len(features)

    def block(row_number: tuple) -> Block:
        (x, y, held_), number = row_number
        return Block(number, np.frombuffer(x, kind).reshape(-1, width), np.frombuffer(y), np.frombuffer(held_, bool))

    return written.coalesce(n).rdd.map(tuple).zipWithIndex().map(block).cache()


def _gradients(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if raw.shape[1] == 1:
        return raw - y[:, None], np.ones_like(raw)
    p = softmax(raw)
    g = p.copy()
    g[np.arange(len(y)), y.astype(np.int64)] -= 1
    return g, np.maximum(2 * p * (1 - p), 1e-16)


def _loss(raw: np.ndarray, y: np.ndarray) -> float:
    if raw.shape[1] == 1:
        return float(((raw[:, 0] - y) ** 2).sum())
    p = softmax(raw)[np.arange(len(y)), y.astype(np.int64)]
    return float(-np.log(np.maximum(p, 1e-15)).sum())


def _raw_of(block: Block, fit: str, classes: int, start: float, trees: list[list[Tree]]) -> np.ndarray:
    """Scores of a block after all ``trees``, going on from what this worker remembers."""
    done, raw = _scores.pop((fit, block.number), (0, None))
    if raw is None or done > len(trees):
        done, raw = 0, np.full((len(block.y), classes), start)
    for group in trees[done:]:
        for k, tree in enumerate(group):
            raw[:, k] += np.array(tree.value)[tree.leaves_of(block.bins, binned=True)]
    _scores[(fit, block.number)] = (len(trees), raw)
    while len(_scores) > REMEMBERED:
        _scores.popitem(last=False)
    return raw


def _sums(block: Block, fit: str, start: float, trees: list[list[Tree]], growing: list[Tree], open_: list[list[int]], settings: Settings):
    """Gradient and hessian sums by class, open node, feature and bin (nulls last); at the roots also the held-out loss."""
    width = settings.bins
    raw = _raw_of(block, fit, len(growing), start, trees)
    at_root = all(len(t.feature) == 1 for t in growing)
    loss = np.array([_loss(raw[block.held], block.y[block.held]), block.held.sum()]) if at_root else np.zeros(2)
    rng = np.random.default_rng((settings.seed, len(trees), block.number))
    used = np.flatnonzero(~block.held & (rng.random(len(block.y)) < settings.row_share))
    g, h = _gradients(raw[used], block.y[used])
    x = block.bins[used]
    null = np.iinfo(x.dtype).max
    most = max(len(o) for o in open_)
    out = np.zeros((len(growing), most, x.shape[1], width + 1, 2))
    for k, (tree, nodes) in enumerate(zip(growing, open_)):
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        place = slot[tree.leaves_of(x, binned=True)]
        rows = np.flatnonzero(place >= 0)
        base = place[rows] * (width + 1)
        for f in range(x.shape[1]):
            cell = base + np.where(x[rows, f] == null, width, x[rows, f])
            for c, of in enumerate((g, h)):
                out[k, :, f, :, c] = np.bincount(cell, of[rows, k], most * (width + 1)).reshape(most, width + 1)
    return out, loss


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_splits(sums: np.ndarray, allowed: np.ndarray, s: Settings):
    """For each (class, node): gain, feature, bin, whether nulls go left, and left sums.  Shapes (K, A), sums (K, A, 2)."""
    total = sums[:, :, 0].sum(axis=2)  # any feature adds up to the node
    known, null = sums[:, :, :, :-1].cumsum(axis=3), sums[:, :, :, -1:]
    left = np.stack([known + null, known], axis=3)  # (K, A, F, side of nulls, bin, 2)
    right = total[:, :, None, None, None] - left
    gain_of = lambda v: _soft(v[..., 0], s.l1) ** 2 / (v[..., 1] + s.l2 + 1e-300)
    gain = gain_of(left) + gain_of(right) - gain_of(total)[:, :, None, None, None]
    enough = (left[..., 1] >= s.least_hessian) & (right[..., 1] >= s.least_hessian) & (left[..., 1] > 0) & (right[..., 1] > 0)
    gain = np.where(enough & allowed[:, None, :, None, None], gain, -np.inf)
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(axis=2)
    f, side, bin_ = np.unravel_index(best, gain.shape[2:])
    k, a = np.indices(best.shape)
    return flat[k, a, best], f, bin_, side == 0, left[k, a, f, side, bin_], total


def fit(
    df: DataFrame, features: Sequence[str], label: str, classes: int = 1, held: str | None = None, settings: Settings = Settings(), **changes: object
) -> Boosted:
    """Boost ``classes`` trees a round on codes 0..classes-1 in ``label`` (one class: on a number, by squared error).

    Rows whose boolean ``held`` is true are left out of the trees and stop them: after ``patience`` rounds in which their mean
    loss fell by no more than ``tolerance`` (a share of the loss without trees), the trees up to the best round are kept.
    Rows without a label take no part; a null feature is a value of its own, as is nan.
    """
    s = Settings(**{**vars(settings), **changes})
    known = df.where(F.col(label).isNotNull())
    learned = known.where(~F.coalesce(F.col(held).cast("boolean"), F.lit(False))) if held else known
    edges = bin_edges(learned, features, s.bins)
    blocks = _blocks(known, features, label, held, edges, s.bins)
    start = float(learned.agg(F.avg(label)).first()[0] or 0.0) if classes == 1 else 0.0
    name, many = uuid.uuid4().hex, blocks.getNumPartitions() > 1

    def add(a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1]

    def summed(*state: object) -> tuple:
        made = blocks.map(lambda block: _sums(block, name, start, *state, s))
        return made.treeReduce(add) if blocks.getNumPartitions() > 16 else made.reduce(add)

    def alone(block: Block) -> tuple[list[list[Tree]], list[float]]:
        return _boost(lambda *state: _sums(block, name, start, *state, s), edges, classes, s)

    try:
        # the sums of a table of one block need no merging, so the task that holds the block goes on by itself
        trees, losses = _boost(summed, edges, classes, s) if many else blocks.map(alone).collect()[0]
    finally:
        blocks.unpersist()
    return Boosted(list(features), classes, start, trees, losses)


def _boost(summed: Callable[..., tuple], edges: list[np.ndarray], classes: int, s: Settings) -> tuple[list[list[Tree]], list[float]]:
    """Rounds of trees from sums over all blocks, and the mean loss on held-out rows before each round."""
    trees: list[list[Tree]] = []
    losses: list[float] = []
    rng, best = np.random.default_rng(s.seed), (np.inf, 0)
    for number in range(s.rounds + 1):
        growing = [Tree() for _ in range(classes)]
        for tree in growing:
            tree.add(0.0, 0.0)
        open_ = [[0] for _ in growing]
        allowed = np.zeros((classes, len(edges)), bool)
        for row in allowed:
            row[rng.choice(len(edges), max(1, round(s.feature_share * len(edges))), replace=False)] = True
        for level in range(s.depth):
            sums, loss = summed(trees, growing, open_)
            if level == 0 and loss[1]:
                losses.append(float(loss[0] / loss[1]))
                if losses[-1] < best[0] - s.tolerance * losses[0]:
                    best = (losses[-1], number)
                elif number - best[1] >= s.patience:
                    return trees[: best[1]], losses
            if number == s.rounds:
                break
            open_ = _grown(growing, open_, best_splits(sums, allowed, s), edges, s, level == 0)
            if not any(open_):
                break
        if number < s.rounds:
            trees.append(growing)
    return trees[: best[1]] if losses else trees, losses


def _grown(growing: list[Tree], open_: list[list[int]], found: tuple, edges: list[np.ndarray], s: Settings, root: bool) -> list[list[int]]:
    """Split open nodes where that gains something; the children are open next."""
    gain, feature, bin_, null_left, left, total = found
    weight = lambda v: float(-s.rate * _soft(v[0], s.l1) / (v[1] + s.l2 + 1e-300))
    after: list[list[int]] = []
    for k, (tree, nodes) in enumerate(zip(growing, open_)):
        children: list[int] = []
        for a, node in enumerate(nodes):
            if root:
                tree.value[node], tree.cover[node] = weight(total[k, a]), float(total[k, a, 1])
            if not gain[k, a] > s.least_gain + 1e-12:
                continue
            f, b = int(feature[k, a]), int(bin_[k, a])
            sides = [tree.add(weight(v), float(v[1])) for v in (left[k, a], total[k, a] - left[k, a])]
            # the last edge is the largest value: all known ones go left, also those to come
            b, cut = (b, float(edges[f][b])) if b < len(edges[f]) - 1 else (s.bins, np.inf)
            tree.split(node, f, b, cut, bool(null_left[k, a]), *sides)
            children += sides
        after.append(children)
    return after
