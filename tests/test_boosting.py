"""Boosted trees, their attributions, and least squares from moments."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewheel.models import attribution, boosting, least_squares
from tidewheel.session import run_dir

NAMES = list("abcdef")


def planted(n=1500):
    """Three classes by a rule that also asks whether a value is there at all; every tenth row is held out."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 6))
    x[rng.random((n, 6)) < 0.05] = np.nan
    y = np.where(np.nan_to_num(x[:, 0], nan=2) > 0.5, 2, (np.nan_to_num(x[:, 1]) + np.nan_to_num(x[:, 2]) > 0).astype(int))
    out = pd.DataFrame(x, columns=NAMES)
    return out.assign(y=y, number=3 * np.nan_to_num(x[:, 0], nan=-5) + np.abs(np.nan_to_num(x[:, 3])), held=np.arange(n) % 10 == 0, test=np.arange(n) % 10 == 1)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(planted()).replace(float("nan"), None)


def test_classes_of_a_planted_rule(spark, rows):
    model = boosting.fit(rows.where("NOT test"), NAMES, "y", 3, "held")
    assert 10 < model.rounds < 300 and model.losses[model.rounds] < 0.1 * model.losses[0]
    scored = model.transform(rows.where("test").withColumn("held", F.lit("other")))
    right = scored.agg(F.avg((F.col("prediction") == F.col("y")).cast("int")), F.max(F.abs(F.aggregate("probability", F.lit(-1.0), lambda a, v: a + v)))).first()
    assert right[0] > 0.97 and right[1] < 1e-12
    path = run_dir(spark, "boosted")
    model.save(spark, path)
    again = boosting.load(spark, path)
    x = planted()[NAMES].to_numpy()
    assert np.array_equal(again.raw(x), model.raw(x)) and again.features == NAMES and again.losses == model.losses


def test_blocks_add_up_to_one(rows, monkeypatch):
    whole = boosting.fit(rows, NAMES, "number", held="held", rounds=8, row_share=1.0, depth=4)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    parts = boosting.fit(rows, NAMES, "number", held="held", rounds=8, row_share=1.0, depth=4)
    x = planted()[NAMES].to_numpy()
    assert np.allclose(whole.raw(x), parts.raw(x), atol=1e-9) and whole.rounds == parts.rounds == 8
    assert [len(t.feature) for g in whole.trees for t in g] == [len(t.feature) for g in parts.trees for t in g]


def test_noise_stops_early(rows):
    model = boosting.fit(rows.withColumn("y", F.pmod(F.hash("a", "b"), F.lit(2))), ["d", "e"], "y", 2, "held", patience=5)
    assert model.rounds < 20 and len(model.losses) <= model.rounds + 6


def test_splits_are_regularised(rows):
    nodes = lambda **s: sum(len(t.feature) for g in boosting.fit(rows, NAMES, "number", rounds=3, row_share=1.0, **s).trees for t in g)
    plain = nodes()
    assert nodes(least_gain=1e9) == 3 and nodes(least_hessian=200.0) < plain and nodes(l1=1e9) == 3
    x = planted()[NAMES].to_numpy()
    size = lambda l2: np.abs(boosting.fit(rows, NAMES, "number", rounds=1, l2=l2).raw(x)).mean()
    base = boosting.fit(rows, NAMES, "number", rounds=0)
    assert base.trees == [] and np.allclose(base.raw(x), planted()["number"].mean())
    assert abs(size(1e9) - abs(base.start)) < 1e-3


def test_first_tree_by_hand(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0), (2.0, 10.0), (None, 20.0), (None, 22.0)], "x double, y double")
    model = boosting.fit(rows, ["x"], "y", rounds=1, rate=1.0, depth=2, row_share=1.0, l2=0.0, least_hessian=1.0)
    got = model.raw(np.array([[0.0], [1.0], [1.5], [2.0], [9.0], [np.nan]]))[:, 0]
    assert got == pytest.approx([2, 2, 10, 10, 10, 21])


def test_empty_constant_and_null_labels(spark):
    kind = "x double, y double"
    assert boosting.fit(spark.createDataFrame([(1.0, 4.0)] * 3 + [(2.0, None)], kind), ["x"], "y", rounds=2).raw(np.zeros((1, 1)))[0, 0] == 4
    model = boosting.fit(spark.createDataFrame([(None, 4.0), (None, 5.0)], kind), ["x"], "y", rounds=2)
    assert model.raw(np.array([[np.nan], [3.0]]))[:, 0] == pytest.approx([4.5, 4.5])


# attributions


def brute_attributions(tree, x):
    """Shapley values of one row by their definition, unknown features weighed by training cover."""

    def value(known, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        left, right = tree.left[node], tree.right[node]
        if f in known:
            goes_left = tree.null_left[node] if np.isnan(x[f]) else x[f] <= tree.cut[node]
            return value(known, left if goes_left else right)
        return (tree.cover[left] * value(known, left) + tree.cover[right] * value(known, right)) / tree.cover[node]

    names, out = range(len(x)), []
    for f in names:
        others, total = [g for g in names if g != f], 0.0
        for size in range(len(others) + 1):
            weight = math.factorial(size) * math.factorial(len(others) - size) / math.factorial(len(x))
            total += sum(weight * (value({*s, f}) - value(set(s))) for s in itertools.combinations(others, size))
        out.append(total)
    return out


def test_attributions_by_definition(rows):
    model = boosting.fit(rows, NAMES, "y", 3, "held", rounds=2, depth=5)
    x = planted()[NAMES].to_numpy()[:25]
    for group in model.trees:
        for tree in group:
            got, mean = attribution.tree_attributions(tree, x)
            assert np.allclose(got, [brute_attributions(tree, row) for row in x], atol=1e-10)
            covers = np.array(tree.cover) * (np.array(tree.feature) < 0)
            assert mean == pytest.approx(np.average(tree.value, weights=covers), rel=1e-9)


def test_explained_rows_add_up(rows):
    model = boosting.fit(rows, NAMES, "y", 3, rounds=4)
    found = attribution.explain(model, rows.withColumn("class", F.lit("x")).withColumn("score", F.lit(1)).withColumn("id", F.monotonically_increasing_id()), ["id"])
    sums = found.groupBy("id", "class").agg(F.sum("attribution").alias("s"), F.first("score").alias("p"), F.first("mean_score").alias("m"))
    assert sums.where("abs(s - (p - m)) > 1e-9").count() == 0 and sums.count() == 3 * 1500
    sizes = {r.feature: r.mean_abs for r in attribution.mean_attributions(found).collect()}
    assert min(sizes[f] for f in "abc") > max(sizes[f] for f in "def")


# least squares


def test_moments_solve_all_targets(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)) * [1, 10, 0.1, 1] + [0, 1e6, 5, 0]
    x[:, 3] = 2 * x[:, 0]  # tells nothing new
    y = np.stack([x @ [1, 2, 3, 0] + 7, rng.normal(size=300)], axis=1)
    df = spark.createDataFrame([(i % 3, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y))] + [(0, None, [1.0, 1.0]), (0, [1.0, None, 1.0, 1.0], [1.0, 1.0])], "part int, x array<double>, y array<double>")
    parts = least_squares.moments(df, "x", "y", "part")
    assert sorted(parts) == [0, 1, 2] and [m.n for m in parts.values()] == [100] * 3
    whole = parts[0] + parts[1] + parts[2]
    model = whole.solve()
    ones = np.hstack([x[:, :3], np.ones((300, 1))])
    best = np.linalg.lstsq(ones - np.append(x[:, :3].mean(axis=0), 0), y, rcond=None)[0]
    guess = x @ model.weights + model.intercepts
    assert np.allclose(guess, (ones - np.append(x[:, :3].mean(axis=0), 0)) @ best, atol=1e-5)
    errors = ((y - guess) ** 2).sum(axis=0)
    assert whole.errors(model)[1] == pytest.approx(errors[1], rel=1e-6) and whole.errors(model)[0] < 1e-3
    assert whole.spread() == pytest.approx(((y - y.mean(axis=0)) ** 2).sum(axis=0))
    got = df.where("part = 1 AND x IS NOT NULL").select(model.apply(F.col("x")).alias("p")).collect()
    assert np.allclose([r.p for r in got], guess[1::3])


def test_expanding_fits_equal_separate_fits(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 2))
    y = x @ [2.0, -1.0] + 3 + rng.normal(size=400)
    fold = np.arange(400) * 4 // 400
    df = spark.createDataFrame([(int(f), float(a), float(b), float(t)) for f, (a, b), t in zip(fold, x, y)], "fold int, a double, b double, y double")
    for r in least_squares.expanding_fits(df, ["a", "b"], "y", 3).collect():
        before, own = fold < r.fold, fold == r.fold
        c, *_ = np.linalg.lstsq(np.column_stack([x[before], np.ones(before.sum())]), y[before], rcond=None)
        left = y[own] - x[own] @ c[:2] - c[2]
        assert r.coefficients == pytest.approx(c[:2]) and r.intercept == pytest.approx(c[2]) and r.test_samples == 100
        assert r.rmse == pytest.approx(np.sqrt((left**2).mean())) and r.r2 == pytest.approx(1 - (left**2).sum() / ((y[own] - y[own].mean()) ** 2).sum())


def test_moments_of_nothing(spark):
    df = spark.createDataFrame([], "fold int, a double, y double")
    assert least_squares.expanding_fits(df, ["a"], "y", 3).count() == 0
    constant = spark.createDataFrame([(0, 1.0, 4.0)] * 3 + [(1, 1.0, 5.0)], "fold int, a double, y double")
    assert [(r.fold, r.rmse, r.r2) for r in least_squares.expanding_fits(constant, ["a"], "y", 3).collect()] == [(1, 1.0, None)]
