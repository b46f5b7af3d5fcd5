"""Quantiles, cleaning, roll-ups, profiles, metrics, splits, scalers and codes against pandas or by hand."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tidewheel.models.classify import tertile_label
from tidewheel.operators import clean, encode, joins, lattice, metrics, profile, quantiles, rollup, scale, split

PROBS = {"a": 0.0, "b": 0.25, "c": 1 / 3, "d": 0.5, "e": 0.95, "f": 1.0}


@pytest.mark.parametrize("n, spread", [(1, 5), (2, 5), (7, 3), (500, 20), (500, 10**6)])
def test_exact_quantiles(spark, n, spread):
    rng = np.random.default_rng(n + spread)
    values = rng.integers(0, spread, n).astype(float)
    keys = np.where(rng.random(n) < 0.7, "hot", "cold")
    pdf = pd.DataFrame({"k": keys, "v": values})
    df = spark.createDataFrame([*map(tuple, pdf.itertuples(index=False)), ("hot", None)], "k string, v double")
    whole = quantiles.exact_quantiles(df, "v", PROBS).first()
    assert all(math.isclose(whole[p], np.quantile(values, q), abs_tol=1e-6) for p, q in PROBS.items())
    for row in quantiles.exact_quantiles(df, "v", PROBS, ["k"]).collect():
        own = pdf[pdf.k == row.k].v
        assert all(math.isclose(row[p], np.quantile(own, q), abs_tol=1e-6) for p, q in PROBS.items())


def test_approximate_quantiles(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    assert abs(quantiles.approx_quantiles(df, "v", {"m": 0.5}).first().m - 5000) < 10


def test_tertiles_like_qcut(spark):
    values = [1.0, 2.0, 2.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    want = pd.qcut(pd.Series(values), q=3, labels=[0, 1, 2]).astype(int).tolist()
    assert [r.label for r in tertile_label(df, "x").orderBy("i").collect()] == want


def test_outliers(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = clean.outlier_summary(df, "v").first()
    assert (row.q1, row.q3, row.outliers) == (11.25, 13.75, 1)
    assert math.isclose(row.outlier_pct, 100 / 7)
    assert [r.v for r in clean.flag_outliers(df, "v").where("is_outlier").collect()] == [100.0]


def test_missing_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "`a b` int, s string")
    out = {r.column_name: (r.missing, r.missing_pct) for r in clean.missing_report(df).collect()}
    assert out == {"a b": (1, 33.33), "s": (2, 66.67)}
    assert clean.missing_report(df.dropna()).count() == 0


def test_slice_guard(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("b", "x")] * 10, "k string, s string")
    narrow, wide = F.col("k") == "a", F.col("s") == "x"
    assert clean.slice_or_widen(df, narrow, wide, 3).count() == 3
    assert clean.slice_or_widen(df, narrow, wide, 4).count() == 13
    assert len(clean.require_rows(df, 13).collect()) == 13
    with pytest.raises(Exception, match="fewer than 14"):
        clean.require_rows(df, 14).collect()


def test_filters(spark):
    df = spark.createDataFrame([(-1.0, 1990), (0.0, 2000), (5.0, 2024), (None, 2025)], "v double, y int")
    assert clean.positive(df, "v").count() == 1
    assert clean.within(df, "y", 1990, 2024).count() == 3
    assert clean.within(df, "y", 1990, 2024, closed=False).count() == 1
    assert clean.drop_null(df).count() == 3 and clean.drop_null(df, ["y"]).count() == 4
    names = spark.createDataFrame([("Ablation_x",), ("Naive_Baseline",), ("Forest",)], "n string")
    assert [r.n for r in names.where(clean.name_excludes("n", "Ablation", "Baseline")).collect()] == ["Forest"]


def test_two_stage_mean_differs_from_one_stage(spark):
    rows = [("a", "2020-01-01", 1.0)] * 3 + [("a", "2020-01-02", 9.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double").withColumn("d", F.to_date("d"))
    assert rollup.two_stage_mean(df, "k", "d", "v").first().avg_value == 5.0


def test_top_and_best(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 1.0), ("d", None)], "n string, v double")
    assert [r.n for r in rollup.top(df, 2, "v", ["n"]).collect()] == ["a", "b"]
    assert rollup.best_record(df, "v", largest=False).first().n == "c"
    totals = spark.createDataFrame([("x", 5.0), ("y", 3.0), ("y", 4.0), ("z", 1.0)], "k string, v double")
    assert {r.k for r in rollup.keep_top_keys(totals, "k", "v", 2).collect()} == {"x", "y"}


def test_latest_and_union(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 1), ("a", 2, 3.0, 1), ("a", 1, 2.0, 9), ("b", 0, 7.0, 0)], "k string, b int, v double, u int")
    assert {(r.k, r.v) for r in rollup.latest(df, ["k"], ["b", "u"]).collect()} == {("a", 3.0), ("b", 7.0)}
    ragged = rollup.union_ragged([df.select("k"), df.select("v")])
    assert ragged.columns == ["k", "v"] and ragged.count() == 8


def test_distinct_guard(spark):
    df = spark.range(30)
    assert rollup.exceeds_distinct(df, "id", 29).first().exceeds and not rollup.exceeds_distinct(df, "id", 30).first().exceeds


def test_profiles_like_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 200), "x": rng.normal(size=200).round(3), "y": rng.normal(size=200).round(3)})
    df = spark.createDataFrame(list(map(tuple, pdf.itertuples(index=False))), "k string, x double, y double")
    row, want = profile.describe(df, "x").first(), pdf.x.describe()
    assert all(math.isclose(row[a], want[b], abs_tol=1e-9) for a, b in
               [("n", "count"), ("mean", "mean"), ("std", "std"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")])
    corr = {(r.feature_a, r.feature_b): r.r for r in profile.correlation(df, ["x", "y"]).collect()}
    assert len(corr) == 4 and math.isclose(corr["x", "y"], pdf.x.corr(pdf.y)) and corr["x", "y"] == corr["y", "x"]
    counts, edges = np.histogram(pdf.x, bins=10)
    got = {r.bin: (r.n, r.bin_start) for r in profile.histogram(df, "x", 10).collect()}
    assert all(got.get(i, (0, 0))[0] == c for i, c in enumerate(counts))
    assert all(math.isclose(s, edges[i]) for i, (_, s) in got.items())
    for row in profile.box_plot(df, ["k"], "x").collect():
        own = pdf[pdf.k == row.k].x
        q1, q3 = own.quantile([0.25, 0.75])
        inside = own[(own >= q1 - 1.5 * (q3 - q1)) & (own <= q3 + 1.5 * (q3 - q1))]
        assert math.isclose(row.q1, q1) and row.whisker_low == inside.min() and row.whisker_high == inside.max()
        assert row.outliers == len(own) - len(inside) and row.n == len(own)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert [(r.bin, r.n) for r in profile.histogram(df, "v", 5).collect()] == [(0, 4)]


def test_regression_scores_match_the_evaluator(spark):
    rows = [(3.0, 2.5), (5.0, 5.5), (2.0, 2.0), (8.0, 7.0), (1.0, 1.5), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    for name in ("mae", "rmse", "r2"):
        want = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert math.isclose(row[name], want)
    assert metrics.regression_metrics(spark.createDataFrame([(1.0, 2.0)] * 2, "y double, p double"), "y", "p").first().r2 is None


def test_class_scores_match_the_evaluator_and_handle_unpredicted_classes(spark):
    rows = [(0, 0), (0, 1), (0, 0), (1, 1), (1, 1), (1, 0), (2, 0), (2, 1), (2, 0)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rows], "y double, p double")
    report = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert (report["2.0"].precision, report["2.0"].recall, report["2.0"].f1, report["2.0"].support) == (0, 0, 0, 3)
    assert math.isclose(report["0.0"].precision, 0.4) and math.isclose(report["0.0"].recall, 2 / 3)
    row = metrics.classification_metrics(df, "y", "p").first()
    for mine, name in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "weightedFMeasure")):
        want = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert math.isclose(row[mine], want)


def test_group_errors_and_map(spark):
    df = spark.createDataFrame([("s", 1.0, 2.0), ("s", 3.0, 3.0), ("t", 0.0, 4.0)], "g string, y double, p double")
    errors = metrics.group_errors(df, "y", "p", ["g"])
    folded = metrics.errors_as_map(errors, "g").first().sector_errors
    assert folded["s"].mae == 0.5 and folded["t"].rmse == 4 and folded["s"]["count"] == 2


def test_comparison_tables(spark):
    rows = [("Forest_A", "t", 1.0, 2.0, 0.5, 10, None), ("Naive_Baseline", None, 0.5, 1.0, 0.9, None, None),
            ("Boosted_B", "t", 1.0, 2.0, 0.6, 10, None), ("Cls", "c", None, None, None, 5, 0.75)]
    df = spark.createDataFrame(rows, "model_type string, task string, mae double, rmse double, r2 double, test_samples long, accuracy double")
    assert metrics.best_regression(df).first().model_type == "Boosted_B"
    table = {r.model: r for r in metrics.regression_table(df).collect()}
    assert len(table) == 3 and table["Forest A"].mae == "1.0000" and table["Naive Baseline"].test_samples == "-"
    full = df.withColumns({c: F.col("accuracy") for c in ("precision", "recall", "f1")})
    assert metrics.classification_table(full).first().accuracy == "0.7500"


def test_paired_t(spark):
    df = spark.createDataFrame([(0.0, 3.0, 1.0), (0.0, 5.0, 2.0), (0.0, 2.0, 2.0)], "y double, a double, b double")
    d = np.array([2.0, 3.0, 0.0])
    assert math.isclose(metrics.paired_t(df, "y", "a", "b").first().t, d.mean() / (d.std(ddof=1) / math.sqrt(3)))


def test_hash_split(spark):
    df = spark.range(20_000)
    a = split.hash_split(df, ["id"], split.TRAIN_VALIDATION_TEST)
    n = {r.split: r["n"] for r in a.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sum(n.values()) == 20_000 and abs(n["train"] / 20_000 - 0.8) < 0.02 and abs(n["test"] / 20_000 - 0.1) < 0.02
    b = split.hash_split(df.repartition(7), ["id"], split.TRAIN_VALIDATION_TEST)
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(split.hash_split(df, ["id"], split.TRAIN_VALIDATION_TEST, seed=1)).count() > 0


def test_stratified_split(spark):
    df = spark.createDataFrame([(i, "a" if i % 11 else "b") for i in range(1100)], "i int, y string")
    out = split.stratified_split(df, "y", ["i"])
    n = {(r.y, r.split): r["n"] for r in out.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert n == {("a", "train"): 800, ("a", "test"): 200, ("b", "train"): 80, ("b", "test"): 20}


def test_scalers(spark):
    df = spark.createDataFrame([("a", 1.0, 7.0), ("a", 3.0, 7.0), ("b", 10.0, 7.0), ("b", 30.0, 7.0)], "k string, v double, c double")
    out = scale.scale_min_max(df, scale.fit_min_max(df, ["v", "c"]), ["v", "c"])
    assert sorted(r.v for r in out.collect())[::3] == [0.0, 1.0] and {r.c for r in out.collect()} == {0.0}
    grouped = scale.scale_min_max(df, scale.fit_min_max(df, ["v"], ["k"]), ["v"], ["k"])
    back = grouped.select(scale.min_max_inverse(F.col("v"), F.col("v_min"), F.col("v_max")).alias("v"))
    assert sorted(r.v for r in grouped.collect()) == [0, 0, 1, 1] and sorted(r.v for r in back.collect()) == [1, 3, 10, 30]
    z = [r.v for r in scale.scale_standard(df, scale.fit_standard(df, ["v", "c"]), ["v", "c"]).collect()]
    assert math.isclose(np.mean(z), 0, abs_tol=1e-12) and math.isclose(np.std(z), 1)


def test_codes(spark):
    df = spark.createDataFrame([("m", 1), ("b", 2), ("b", 1), (None, 10), ("a", 2)], "s string, n int")
    coded = {(r.s, r.n): (r.s_encoded, r.n_encoded) for r in encode.encode(df, ["s", "n"]).collect()}
    assert coded == {("m", 1): (2, 0), ("b", 2): (1, 2), ("b", 1): (1, 0), (None, 10): (None, 1), ("a", 2): (0, 2)}
    freq = {r.s: r.code for r in encode.frequency_codes(df, "s", "code").collect()}
    assert freq == {"b": 0, "a": 1, "m": 2}
    unseen = encode.index_by_frequency(df.where("s <> 'a'"), df, "s", "code").collect()
    assert {r.s: r.code for r in unseen} == {"b": 0, "m": 1, "a": 2, None: 2}


def test_quantiles_of_odd_groups(spark):
    rows = [("a", None), ("b", 1.0), ("c", 2.0), ("c", 4.0), (None, 7.0), (None, 9.0), (None, 8.0)] + [("hot", 5.0)] * 3000 + [("hot", float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("_v", F.lit(1)).withColumn("_c", F.lit(1)).withColumn("_n", F.lit(2))
    found = {r.k: tuple(r)[1:] for r in quantiles.exact_quantiles(df, "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}, ["k"]).collect()}
    hot = np.array([v for k, v in rows if k == "hot"])
    assert found == {"b": (1, 1, 1), "c": (2, 3, 4), None: (7, 8, 9), "hot": (0, np.median(hot), 2999)}
    none = quantiles.exact_quantiles(df.where("k = 'a'"), "v", {"mid": 0.5}).collect()
    assert [tuple(r) for r in none] == [(None,)]


def test_quantiles_count_inside_brackets_only(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=50_000), np.full(20_000, 0.25), rng.integers(0, 9, 5_000)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(16)
    # a coarse sketch, so that most rows lie outside
    found = quantiles.exact_quantiles(df, "v", {"a": 0.01, "b": 0.37, "c": 0.99}, accuracy=100).first()
    assert tuple(found) == pytest.approx(tuple(np.quantile(values, [0.01, 0.37, 0.99])), abs=0)
    plan = quantiles.exact_quantiles(df, "v", {"b": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("most", [100_000, 1])
def test_rows_of_hot_groups_are_not_sorted(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "BROADCAST_GROUPS", most)
    rows = [(k, float(i)) for k in ("a", None, "a", "b") for i in range(101)] + [("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = quantiles.exact_quantiles(df, "v", {"m": 0.5}, ["k"])
        coded = encode.encode(df, ["k"])
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (found, coded)]
        assert {r.k: r.m for r in found.collect()} == {"a": 50, None: 50, "b": 50}
        assert {(r.k, r.k_encoded) for r in coded.collect()} == {("a", 0), ("b", 1), ("c", 2), (None, None)} and coded.count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "SortMergeJoin" not in plan and ("BroadcastHashJoin" if most > 1 else "ShuffledHashJoin") in plan


def test_lattice_merges_days_and_levels(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "hot", "hot", "hot"], 900), "d": rng.integers(0, 40, 900), "v": rng.normal(5, 2, 900)})
    rows = [*map(tuple, pdf.itertuples(index=False)), (None, 1, 2.0), ("a", 1, None), ("empty", 1, None)]
    df = spark.createDataFrame([(k, int(d), v) for k, d, v in rows], "k string, d long, v double").withColumn("n", F.lit(1))
    whole = lattice.states(df, ["k", "d"], "v")
    later = lattice.merged([lattice.states(df.where("d < 20"), ["k", "d"], "v"), lattice.states(df.where("d >= 20 OR d = 3"), ["k", "d"], "v")], ["k", "d"])
    levels = {"k": [F.col("k")], "week": [F.floor(F.col("d") / 7)], "all": []}
    got = {(r.rollup, *r["keys"]): r for r in lattice.roll_up(whole, levels).collect()}
    again = {(r.rollup, *r["keys"]): r for r in lattice.roll_up(later.where("d <> 3"), levels).collect()}
    own = pdf[pdf.k == "hot"].v
    r = got["k", "hot"]
    assert (r.n, r.low, r.high) == (len(own), own.min(), own.max()) and r.mean == pytest.approx(own.mean()) and r.std == pytest.approx(own.std())
    assert got["k", None].n == 1 and got["k", None].std is None and got["k", "empty"].n == 0 and got["k", "empty"].mean is None
    assert got["all",].n == 901 and again["week", "5"].total == pytest.approx(got["week", "5"].total)
    assert set(r.rollup for r in got.values()) == {"k", "week", "all"}
