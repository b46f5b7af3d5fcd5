from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidewheel.operators import series as S
from tidewheel.operators.split import chronological_split, global_split
from tidewheel.panel import Panel

DAILY = Panel(("k",), "d", "v", daily=True)
FREE = Panel(("k",), "d", "v")
START = date(2020, 1, 1)


def frame(spark, values, key="a"):
    rows = [(key, START + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, d date, v double")


def column(df, name):
    return [r[name] for r in df.orderBy("k", "d").collect()]


def test_windows_on_one_series(spark):
    df = frame(spark, [float(i) for i in range(35)])
    out = S.over_series(df, DAILY, {
        "incl": S.rolling_mean("v", 7), "strict": S.rolling_mean("v", 7, strict=True), "past": S.past_mean("v", 7),
        "lag7": S.lag("v", 7), "lag30": S.lag("v", 30),
    }).orderBy("d").collect()
    assert out[0]["incl"] == 0 and out[0]["strict"] is None and out[0]["past"] is None
    assert out[3]["incl"] == 1.5 and out[3]["past"] == 1
    assert out[6]["strict"] == 3 and out[5]["strict"] is None
    assert out[20]["incl"] == 17 and out[20]["past"] == 16
    assert out[6]["lag7"] is None and out[7]["lag7"] == 0 and out[34]["lag30"] == 4


def test_change_by_zero_and_null(spark):
    df = frame(spark, [0.0, 5.0, None, 10.0, 15.0])
    assert column(S.over_series(df, DAILY, {"c": S.pct_change("v")}), "c") == [None, None, None, None, 50.0]


def test_null_values_are_skipped_by_means(spark):
    df = frame(spark, [2.0, None, 4.0])
    assert column(S.over_series(df, DAILY, {"m": S.rolling_mean("v", 3)}), "m") == [2.0, 2.0, 3.0]


def test_value_of_a_day_never_reaches_its_own_features(spark):
    base = [float(i % 9) for i in range(60)]
    changed = [*base]
    changed[40] = 1e6
    names = ["rolling_avg_7d", "rolling_avg_30d", "lag_1d", "lag_7d", "lag_30d"]
    a = S.trailing_features(frame(spark, base), DAILY).orderBy("d").collect()
    b = S.trailing_features(frame(spark, changed), DAILY).orderBy("d").collect()
    assert all(a[40][n] == b[40][n] for n in names)
    assert any(a[41][n] != b[41][n] for n in names)


@pytest.mark.parametrize("n, pairs", [(36, 0), (37, 1), (38, 2)])
def test_sequence_counts(spark, n, pairs):
    out = S.sequences(frame(spark, [float(i) for i in range(n)]), DAILY).orderBy("d").collect()
    assert len(out) == pairs
    if pairs:
        assert out[0]["inputs"] == [float(i) for i in range(30)]
        assert out[0]["targets"] == [float(i) for i in range(30, 37)]


@pytest.mark.parametrize("piece", [1, 4, 7, 1000])
def test_cut_series_give_the_same_as_whole_ones(spark, piece):
    rows = [(("hot" if i % 3 else f"k{i % 5}"), START + timedelta(days=i), None if i % 13 == 0 else float(i * i % 31)) for i in range(240)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    columns = {
        "m": S.rolling_mean("v", 7), "s": S.rolling_mean("v", 5, strict=True), "p": S.past_mean("v", 9), "l": S.lag("v", 11),
        "c": S.pct_change("v"), "i": S.past_values("v", 6), "t": S.next_values("v", 3),
    }
    whole = S.over_series(df, DAILY, columns)
    cut = S.over_series(df, FREE, columns, piece_rows=piece)
    keep = ["k", "d", "v", *columns]
    assert [tuple(r) for r in cut.select(keep).orderBy("k", "d").collect()] == [
        tuple(r) for r in whole.select(keep).orderBy("k", "d").collect()
    ]


def test_cumulative_both_ways(spark):
    df = frame(spark, [1.0, None, 3.0, 8.0] * 20)
    names = ["cumulative_sum", "cumulative_count", "cumulative_avg"]
    a = S.cumulative(df, DAILY).orderBy("d").select(names).collect()
    b = S.cumulative(df, FREE).orderBy("d").select(names).collect()
    assert a == b and a[3]["cumulative_avg"] == 4


@pytest.mark.parametrize("panel", [DAILY, FREE])
def test_splits_of_daily_and_other_panels_agree(spark, panel):
    df = frame(spark, [float(i) for i in range(25)]).unionByName(frame(spark, [1.0] * 10, "b"))
    parts = {(r.k, r.split): r["n"] for r in chronological_split(df, panel).groupBy("k", "split").agg(F.count("*").alias("n")).collect()}
    assert parts == {("a", "train"): 20, ("a", "test"): 5, ("b", "train"): 8, ("b", "test"): 2}
    whole = {(r.k, r.split): r["n"] for r in global_split(df, panel).groupBy("k", "split").agg(F.count("*").alias("n")).collect()}
    assert whole == {("a", "train"): 25, ("b", "train"): 3, ("b", "test"): 7}
