from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidewheel.models import classify, forecast, importance, regression
from tidewheel.models.features import FEATURES, panel_features
from tidewheel.operators.metrics import classification_metrics, regression_metrics
from tidewheel.operators.split import expanding_folds, hash_split, stratified_split
from tidewheel.panel import Panel
from tidewheel.session import run_dir
from tidewheel.sources.writers import load_model, save_model, score

PANEL = Panel(("country", "sector"), "d", "v", daily=True)


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    for c, base in (("A", 50.0), ("B", 500.0)):
        for i in range(200):
            rows.append((c, "s", date(2022, 1, 1) + timedelta(days=i), base * (1 + 0.2 * np.sin(2 * np.pi * i / 7)).item() + i % 3))
    return spark.createDataFrame(rows, "country string, sector string, d date, v double")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    rows = [(i, float(a), float(b), float(c), "red" if a > 0 else "blue", float(4 * a + b * b)) for i, (a, b, c) in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, colour string, y double")


def test_feature_table(daily):
    out = panel_features(daily, PANEL)
    assert set(FEATURES) <= set(out.columns) and out.count() == 2 * (200 - 7)
    first = out.orderBy("country", "d").first()
    assert first.lag_30d is None and first.country_encoded == 0 and first.sector_encoded == 0


def test_forest_grid_save_and_score(spark, table):
    parts = hash_split(table, ["id"])
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    pipeline = regression.forest_pipeline(["a", "b", "c"], ["colour"], "y", numTrees=10, maxDepth=4)
    found = regression.grid_search(pipeline, train, "y", {"maxDepth": (1, 5)}, folds=2)
    results = {r.params["maxDepth"]: r.rmse for r in regression.grid_results(train, found).collect()}
    assert results["5"] < results["1"]
    path = run_dir(spark, "model")
    save_model(found.bestModel, path)
    scored = score(load_model(path), test, ["id", "y"], "forest")
    assert scored.columns == ["id", "y", "prediction", "model_type", "prediction_date"]
    assert regression_metrics(scored, "y", "prediction").first().r2 > 0.6
    ranked = {r.feature: r.importance for r in regression.importances(found.bestModel, train, ["a", "b", "c", "colour"]).collect()}
    assert ranked["a"] > ranked["c"]


def test_unseen_category_does_not_fail(spark, table):
    model = regression.forest_pipeline(["a"], ["colour"], "y", numTrees=3, maxDepth=2).fit(table)
    assert model.transform(table.withColumn("colour", F.lit("green"))).count() == 400


def test_boosting_stops_early(table):
    rows = table.withColumn("held_out", F.col("id") % 5 == 0).withColumn("noise", F.hash("id") % 100 * 1.0)
    model = regression.boosted(["noise"], "y", "held_out", maxIter=40, stepSize=0.9, maxDepth=4).fit(rows)
    assert model.stages[-1].getNumTrees < 40


def test_ablation_prefers_the_informative_set(table):
    parts = hash_split(table, ["id"])
    out = regression.ablation(
        parts.where("split = 'train'"), parts.where("split = 'test'"), "y", {"poor": ["c"], "rich": ["a", "b"]},
        lambda f: regression.boosted(f, "y", maxIter=5, stepSize=0.3, maxDepth=3),
    )
    rows = {r.model_type: r for r in out.collect()}
    assert rows["rich"].rmse < rows["poor"].rmse and rows["rich"].n_features == 2


def linear(features, label):
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), LinearRegression(labelCol=label)])


def test_partner_is_a_permutation(table):
    paired = importance.with_partner(table, ["a", "b"], ["id"])
    assert paired.count() == 400
    assert sorted(r.x for r in paired.select(F.col("_partner.a").alias("x")).collect()) == sorted(r.a for r in table.collect())
    assert paired.where("_partner.a <> a").count() > 350


def test_permutation_importance(table):
    model = linear(["a", "c"], "y").fit(table)
    out = {r.feature: r for r in importance.permutation_importance(model, table, ["a", "c"], "y", ["id"]).collect()}
    assert out["a"].rmse_growth > 1 and abs(out["c"].rmse_growth) < 0.2 and out["a"].n == 400


def test_expanding_validation_never_sees_the_future(daily):
    rows = expanding_folds(panel_features(daily, PANEL, ("lag_30d",)), PANEL, 3)
    ends = {r.fold: (r.lo, r.hi) for r in rows.groupBy("fold").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}
    assert sorted(ends) == [0, 1, 2, 3] and all(ends[k][1] < ends[k + 1][0] for k in range(3))
    out = regression.expanding_validation(rows, "v", linear(["lag_7d", "lag_1d"], "v"), 3).collect()
    assert [r.fold for r in out] == [1, 2, 3] and all(r.r2 > 0.9 for r in out)


def test_horizon_forecast_beats_the_mean(daily):
    out = forecast.horizon_forecast(daily, PANEL, length=14, horizon=3)
    scores = {r.step: r for r in forecast.horizon_metrics(out).collect()}
    assert sorted(scores) == [0, 1, 2, 3] and scores[0].test_samples == sum(scores[s].test_samples for s in (1, 2, 3))
    assert all(s.r2 > 0.9 for s in scores.values())
    # the last prediction's actual value is the last value of the series
    last = out.where("country = 'A' AND step = 3").orderBy(F.desc("d")).first()
    assert abs(last.actual - daily.where("country = 'A'").orderBy(F.desc("d")).first().v) < 1e-9


def test_scaler_ignores_the_test_part(daily):
    peak = daily.withColumn("v", F.when(F.col("d") > "2022-07-15", 1e6).otherwise(F.col("v")))
    assert forecast.supervised(peak, PANEL).agg(F.max("v_max").alias("m")).first().m < 1000


def test_baselines(daily):
    scored = forecast.baseline_forecasts(daily, PANEL)
    out = {r.model_type: r for r in forecast.baseline_metrics(scored, "v", {"naive": "N", "moving_avg_7d": "M"}).collect()}
    assert out["N"].test_samples == 398 and out["M"].mae > 0


def test_prepare_and_balanced_classifier(spark):
    rng = np.random.default_rng(1)
    rows = [(i, str(rng.choice(["x", "y"])), float(v), "hi" if v > 1 else "mid" if v > -0.5 else "lo") for i, v in enumerate(rng.normal(size=300))]
    df = spark.createDataFrame(rows, "id long, kind string, v double, level string")
    coded, features = classify.prepare(df)
    assert features == ["id", "v", "kind"] and {r.label for r in coded.select("label").distinct().collect()} == {0, 1, 2}
    parts = stratified_split(coded, "label", ["id"])
    model = classify.fit_balanced(parts.where("split = 'train'"), ["v", "kind"], "id", rounds=12, depth=3, rate=0.4)
    scored = model.transform(parts.where("split = 'test'")).withColumn("prediction", F.col("prediction").cast("int"))
    assert classification_metrics(scored, "label", "prediction").first().accuracy > 0.9
    continuous, _ = classify.prepare(df.drop("level").withColumn("target_class", F.col("v") * 2), "target_class")
    sizes = [r["count"] for r in continuous.groupBy("label").count().collect()]
    assert sizes == [100, 100, 100]


def test_prepare_keeps_a_target_called_label(spark):
    rows = [("a" if i % 3 else "b", float(i), "x") for i in range(30)]
    out, features = classify.prepare(spark.createDataFrame(rows, "label string, a double, c string"))
    assert features == ["a", "c"] and {r.label for r in out.collect()} == {0, 1}


def test_prepare_keeps_integer_classes(spark):
    df = spark.createDataFrame([(i % 12, float(i)) for i in range(120)], "target int, a double")
    out, features = classify.prepare(df, "target")
    assert features == ["a"] and all(r.label == int(r.a) % 12 for r in out.collect())
    typed, _ = classify.prepare(df.withColumn("target", F.col("target").cast("double") / 2), "target")
    assert all(r.label == int(r.a) % 12 for r in typed.collect())


def test_prepare_codes_missing_categories(spark):
    rows = [(i, [None, "u", "z"][i % 3], i % 2) for i in range(120)]
    out, _ = classify.prepare(spark.createDataFrame(rows, "a int, c string, label int"))
    assert out.count() == 120
    assert {(r.a % 3, r.c) for r in out.collect()} == {(0, 0), (1, 1), (2, 2)}


def test_prepare_without_text_columns(spark):
    out, features = classify.prepare(spark.createDataFrame([(i, i % 2) for i in range(9)], "a int, label int"))
    assert features == ["a"] and out.count() == 9
