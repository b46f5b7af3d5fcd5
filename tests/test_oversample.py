import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators.neighbours import nearest_in_group
from tidewheel.operators.oversample import oversample


def brute(points, i, k):
    d = ((points - points[i]) ** 2).sum(axis=1)
    d[i] = -1
    return np.sort(d)[1 : k + 1]


@pytest.mark.parametrize("leaf_rows", [10, 60, 10_000])
@pytest.mark.parametrize("copies", [0, 150])
def test_neighbours_match_brute_force(spark, leaf_rows, copies):
    """``copies`` rows, a third of the hot group, are one and the same point."""
    rng = np.random.default_rng(leaf_rows)
    groups = {"hot": rng.normal(size=(300, 3)).round(2), "small": rng.normal(size=(4, 3)).round(2)}
    groups["hot"] = np.vstack([groups["hot"], np.repeat(groups["hot"][:1], copies, axis=0)])
    rows = [(g, [float(x) for x in p]) for g, pts in groups.items() for p in pts]
    df = spark.createDataFrame(rows, "g string, x array<double>").withColumn("q", F.lit(True))
    found = {(r.g, tuple(r.x)): np.array(r.neighbours) for r in nearest_in_group(df, "g", "x", "q", 5, leaf_rows).collect()}
    assert len(found) == len({(g, tuple(x)) for g, x in rows})
    for g, pts in groups.items():
        for i, p in enumerate(pts):
            near = found[g, tuple(p)]
            want = brute(pts, i, 5)
            assert np.allclose(((near - p) ** 2).sum(axis=1), want), (g, p)


@pytest.mark.parametrize("cell_rows", [12, 40])
def test_search_crosses_cells(spark, cell_rows):
    """Points of a grid, so that many lie equally far away, in many cells; a null group, and vectors that take no part."""
    rng = np.random.default_rng(cell_rows)
    groups = {"grid": rng.integers(0, 9, (400, 3)).astype(float), None: rng.normal(size=(90, 3)), "few": rng.normal(size=(3, 3))}
    rows = [(g, [float(x) for x in p]) for g, pts in groups.items() for p in pts]
    odd = [("grid", [1.0, None, 1.0]), ("grid", [1.0, float("nan"), 1.0]), ("grid", [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "g string, x array<double>").withColumn("q", F.lit(True))
    out = nearest_in_group(df, "g", "x", "q", 5, 10, cell_rows=cell_rows).collect()
    found = {(r.g, tuple(r.x)): r.neighbours for r in out}
    assert len(found) == len(out) == len({(g, tuple(x)) for g, x in rows + odd})
    assert all(found.pop((g, tuple(x))) == [] for g, x in odd[::2])
    for g, pts in groups.items():
        for i, p in enumerate(pts):
            others = np.delete(pts, i, axis=0)
            order = np.lexsort((*others.T[::-1], ((others - p) ** 2).sum(axis=1)))[:5]
            assert found[g, tuple(p)] == others[order].tolist(), (g, p)


def test_only_wanted_rows_are_answered(spark):
    df = spark.createDataFrame([("a", [float(i)], i == 3) for i in range(9)], "g string, x array<double>, q boolean")
    out = nearest_in_group(df, "g", "x", "q", 2).collect()
    assert [(r.x, sorted(r.neighbours)) for r in out] == [([3.0], [[2.0], [4.0]])]


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(5)
    rows = [(i, label, *map(float, rng.normal(label * 5, 1, 2)))
            for i, label in enumerate([0] * 90 + [1] * 30 + [2] * 12 + [3])]
    return spark.createDataFrame(rows, "id long, y int, a double, b double")


def test_classes_become_equal_and_points_lie_on_segments(classes):
    out = oversample(classes, "y", ["a", "b"], "id").toPandas()
    assert out.groupby("y").size().to_dict() == {0: 90, 1: 90, 2: 90, 3: 90}
    assert (~out.is_synthetic).sum() == 133
    for label in (1, 2):
        real = out[(out.y == label) & ~out.is_synthetic][["a", "b"]].to_numpy()
        for p in out[(out.y == label) & out.is_synthetic][["a", "b"]].to_numpy():
            u, v = real[:, None, :], real[None, :, :]
            through = np.abs(np.linalg.norm(p - u, axis=2) + np.linalg.norm(p - v, axis=2) - np.linalg.norm(u - v, axis=2))
            assert through.min() < 1e-9
    lone = out[out.y == 3][["a", "b"]].to_numpy()
    assert np.allclose(lone, lone[0])


def test_same_seed_same_rows(classes):
    a = oversample(classes, "y", ["a", "b"], "id", seed=1)
    b = oversample(classes.repartition(5), "y", ["a", "b"], "id", seed=1)
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(oversample(classes, "y", ["a", "b"], "id", seed=2)).count() > 0
