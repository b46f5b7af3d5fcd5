import random

import pytest
from pyspark.sql import functions as F

from tidewheel.operators.ordering import positions, range_piece, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows under one key."""
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 11}", i, rng.randint(0, 9)) for i in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t int, w int").repartition(5)


def test_pieces_follow_the_order_and_split_the_hot_key(skewed):
    _, df = skewed
    cut = range_piece(df, ["k", "t"], pieces=6)
    stats = cut.groupBy("_piece").agg(F.min(F.struct("k", "t")).alias("lo"), F.max(F.struct("k", "t")).alias("hi")).orderBy("_piece").collect()
    assert len(stats) > 3
    assert all(a["hi"] < b["lo"] for a, b in zip(stats, stats[1:]))
    assert cut.where("k = 'hot'").select("_piece").distinct().count() > 2


def test_global_positions(skewed):
    rows, df = skewed
    want = {(k, t): i for i, (k, t, _) in enumerate(sorted(rows))}
    got = {(r.k, r.t): r.position for r in positions(df, ["k", "t"]).collect()}
    assert got == want


def test_group_positions_and_sizes(skewed):
    rows, df = skewed
    got = {(r.k, r.t): (r.position, r.position_total) for r in positions(df, ["t"], ["k"], group_size=True).collect()}
    for key in {k for k, _, _ in rows}:
        times = sorted(t for k, t, _ in rows if k == key)
        assert [got[key, t] for t in times] == [(i, len(times)) for i in range(len(times))]


def test_running_totals_with_null_keys(spark):
    rows = [(None, i, i) for i in range(40)] + [("a", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t int, w int")
    got = {(r.k, r.t): r.s for r in running_totals(df, ["t"], {"s": F.col("w")}, ["k"], pieces=4).collect()}
    assert len(got) == 45
    assert all(got[None, i] == sum(range(i)) for i in range(40))
    assert all(got["a", i] == i for i in range(5))


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_tiny_tables(spark, n):
    df = spark.createDataFrame([(i,) for i in range(n)], "t int")
    assert sorted(r.position for r in positions(df, ["t"]).collect()) == list(range(n))
