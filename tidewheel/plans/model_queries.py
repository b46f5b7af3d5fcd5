"""Registered queries: oversampling, estimators and explanations."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions.calendar import with_year_features
from tidewheel.models import boosting
from tidewheel.models.attribution import explain
from tidewheel.models.classify import fit_balanced, prepare, tertile_label
from tidewheel.models.features import ABLATION_SETS, FEATURES, LAG_FEATURES, ROLLING_FEATURES, SEQUENCE_FEATURES, TIME_FEATURES, panel_features
from tidewheel.models.forecast import horizon_forecast, horizon_metrics, supervised
from tidewheel.models.importance import permutation_importance
from tidewheel.models.least_squares import expanding_fits, moments
from tidewheel.models.regression import (
    HELD_OUT, ablation, boosted, fit_kept, forest_pipeline, grid_results, grid_search, held_out,
    importances, kept,
)
from tidewheel.operators.encode import encode
from tidewheel.operators.neighbours import feature_vector, nearest_in_group
from tidewheel.operators.metrics import class_report, clip_low, regression_metrics
from tidewheel.operators.oversample import oversample
from tidewheel.operators.rollup import top
from tidewheel.operators.split import (
    TRAIN_VALIDATION_TEST, chronological_split, expanding_folds, hash_split, stratified_split, with_series_position,
)
from tidewheel.plans.catalog import query
from tidewheel.plans.adapters import DAILY, INDIVIDUALS, INVENTORY, PANEL, individuals, inventory, panel
from tidewheel.plans.series_queries import SERIES
from tidewheel.session import run_dir
from tidewheel.sources.writers import append, load_model, save_model, score


# Trees differ between engines in ties and sampling, so the tree queries learn a target that follows a planted rule of the
# features: a right model must come close to it, and one that ignores the features cannot.  Linear models have closed
# forms, and their queries return the figures themselves.


def r_squared(label: str) -> Column:
    """Share of the label's variance that ``prediction`` explains."""
    return 1 - F.avg(F.pow(F.col("prediction") - F.col(label), 2)) / F.var_pop(label)


PARTS = f"""{PANEL}, numbered AS (SELECT *, ROW_NUMBER() OVER ({SERIES}) - 1 AS k FROM panel),
  known AS (SELECT *, ROW_NUMBER() OVER ({SERIES}) - 1 AS i, COUNT(*) OVER (PARTITION BY country, sector) AS n FROM numbered WHERE k >= 30),
  parts AS (SELECT *, CASE WHEN i < FLOOR(n * 0.8) THEN 'train' WHEN i < FLOOR(n * 0.9) THEN 'validation' ELSE 'test' END AS split FROM known)"""


INDIVIDUAL_FEATURES = ["segment_encoded", "home_encoded", "order_count", "order_total", "largest_order"]


def labelled_individuals(spark: SparkSession, folder: str) -> DataFrame:
    """Individuals with coded categories and the class by fixed limits, which is unbalanced."""
    from tidewheel.functions.binning import threshold_code

    coded = encode(individuals(spark, folder), ["segment", "home"])
    return coded.withColumn("label", threshold_code(F.col("CarbonEmission")))


@query(
    "smote_counts",
    f"""WITH {INDIVIDUALS}, c AS (SELECT CASE WHEN CarbonEmission < 2500 THEN 0 WHEN CarbonEmission < 5000 THEN 1 ELSE 2 END AS label,
      COUNT(*) AS n FROM individuals GROUP BY 1), t AS (SELECT label, CAST(FLOOR(n * 0.8) AS BIGINT) AS n FROM c)
    SELECT CAST(label AS INTEGER) AS label, n AS original, (SELECT MAX(n) FROM t) - n AS synthetic FROM t""",
)
def smote_counts(spark, folder):
    train = stratified_split(labelled_individuals(spark, folder), "label", ["id"]).where(F.col("split") == "train")
    return (
        oversample(train, "label", INDIVIDUAL_FEATURES, "id")
        .groupBy("label")
        .agg(F.count_if(~F.col("is_synthetic")).alias("original"), F.count_if("is_synthetic").alias("synthetic"))
    )


@query(
    "smote_neighbours",
    f"""WITH {INDIVIDUALS}, r AS (SELECT CAST(CASE WHEN CarbonEmission < 2500 THEN 0 WHEN CarbonEmission < 5000 THEN 1 ELSE 2 END AS INTEGER) AS label,
      CAST(order_count AS DOUBLE) AS a, CAST(order_total AS DOUBLE) AS b, CAST(largest_order AS DOUBLE) AS c FROM individuals),
    q AS (SELECT DISTINCT label, a, b, c FROM r),
    d AS (SELECT q.*, (q.a - k.a) * (q.a - k.a) + (q.b - k.b) * (q.b - k.b) + (q.c - k.c) * (q.c - k.c) AS d2
      FROM q JOIN r k USING (label)),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY label, a, b, c ORDER BY d2) AS place FROM d)
    SELECT label, ROUND(a, 2) AS a, ROUND(b, 2) AS b, ROUND(c, 2) AS c, COUNT(*) AS n, ROUND(SUM(SQRT(d2)), 1) AS distance
    FROM ranked WHERE place BETWEEN 2 AND 6 GROUP BY ALL""",
)
def smote_neighbours(spark, folder):
    """Exact neighbours within every class, with leaves so small that the search crosses them."""
    rows = labelled_individuals(spark, folder).select("label", feature_vector(["order_count", "order_total", "largest_order"]).alias("x"))
    found = nearest_in_group(rows.withColumn("ask", F.lit(True)), "label", "x", "ask", 5, leaf_rows=32)
    away = F.transform("neighbours", lambda y: F.sqrt(F.aggregate(F.zip_with(y, "x", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)))
    return found.where(F.size("neighbours") > 0).select(
        F.col("label").cast("int").alias("label"), *(F.round(F.get("x", F.lit(i)), 2).alias(c) for i, c in enumerate("abc")),
        F.size("neighbours").cast("bigint").alias("n"), F.round(F.aggregate(away, F.lit(0.0), lambda s, v: s + v), 1).alias("distance"),
    )


FOREST_NUMERIC = ["year", "decade", "years_from_1990", "per_capita_tco2"]


def _forest_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Inventory rows, their emissions replaced by a rule: every year adds a little, and later ones are high."""
    rows = with_year_features(inventory(spark, folder).where(F.col("emission_mtco2") > 0), "year", "emission_mtco2")
    ruled = rows.withColumn("emission_mtco2", 100 * (F.col("year") > 1994).cast("double") + 20 * (F.col("year") - 1990))
    parts = hash_split(ruled, ["country_code", "sector", "year"])
    return tuple(parts.where(F.col("split") == part) for part in ("train", "test"))


ALL_INVENTORY = f"WITH {INVENTORY}, rows AS (SELECT * FROM inventory WHERE emission_mtco2 > 0)"


@query("rf_cv_eval", f"{ALL_INVENTORY} SELECT COUNT(*) AS n_rows, 4 AS grid_points, TRUE AS close, TRUE AS best_of_grid FROM rows")
def rf_cv_eval(spark, folder):
    """Forest with its settings chosen by three-fold validation, scored on unseen rows."""
    train, test = _forest_rows(spark, folder)
    pipeline = forest_pipeline(FOREST_NUMERIC, ["country_code", "sector"], "emission_mtco2")
    found = grid_search(pipeline, train, "emission_mtco2")
    grid = grid_results(train, found)
    scored = found.bestModel.transform(test).agg(F.count(F.lit(1)).alias("n"), (r_squared("emission_mtco2") > 0.95).alias("close"))
    chosen = found.bestModel.stages[-1]
    best = grid.agg(F.min_by("params", "rmse").alias("p")).select(
        (F.col("p.numTrees") == str(chosen.getNumTrees)) & (F.col("p.maxDepth") == str(chosen.getOrDefault("maxDepth")))
    )
    return scored.select(
        (F.col("n") + train.count()).alias("n_rows"), F.lit(grid.count()).cast("int").alias("grid_points"), "close",
        best.scalar().alias("best_of_grid"),
    )


@query(
    "rf_importance",
    """SELECT feature, feature = 'years' AS counts, feature = 'years' AS most, CAST(1.0 AS DOUBLE) AS total
    FROM (SELECT UNNEST(['country_code', 'per_capita_tco2', 'sector', 'years']) AS feature)""",
)
def rf_importance(spark, folder):
    """What the rule doesn't use counts for nothing; three columns say the same about the year and share its part."""
    train, _ = _forest_rows(spark, folder)
    model = fit_kept(forest_pipeline(FOREST_NUMERIC, ["country_code", "sector"], "emission_mtco2"), train)
    ranked = top(importances(model, train, [*FOREST_NUMERIC, "country_code", "sector"]), 10, "importance", ["feature"])
    name = F.when(F.col("feature").isin("year", "decade", "years_from_1990"), "years").otherwise(F.col("feature"))
    shares = ranked.groupBy(name.alias("feature")).agg(F.sum("importance").alias("share"))
    total, most = (shares.agg(f("share")).scalar() for f in (F.sum, F.max))
    return shares.select(
        "feature", (F.col("share") > 0.04).alias("counts"), (F.col("share") == most).alias("most"), F.round(total, 9).alias("total")
    )


@query(
    "scored_predictions",
    f"{ALL_INVENTORY} SELECT COUNT(*) AS n_rows, 'random_forest' AS model_type, TRUE AS none_negative, TRUE AS close FROM rows",
)
def scored_predictions(spark, folder):
    """A saved forest, loaded again, scores the test rows into a prediction table."""
    path = run_dir(spark, "forest")
    train, test = _forest_rows(spark, folder)
    forest = forest_pipeline(FOREST_NUMERIC, ["country_code", "sector"], "emission_mtco2")
    save_model(fit_kept(forest, train), f"{path}/model")
    scored = score(load_model(f"{path}/model"), test, ["country_code", "sector", "year", "emission_mtco2"], "random_forest")
    append(scored, path=f"{path}/predictions")
    stored = spark.read.parquet(f"{path}/predictions").withColumn("prediction", clip_low(F.col("prediction")))
    return stored.groupBy("model_type").agg(
        (F.count(F.lit(1)) + F.lit(train.count())).alias("n_rows"), (F.min("prediction") >= 0).alias("none_negative"),
        (r_squared("emission_mtco2") > 0.95).alias("close"),
    )


def _panel_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Features with their split, worked out once for fitting and scoring."""
    rows = panel_features(panel(spark, folder), DAILY, ("lag_7d", "lag_30d"))
    return kept(chronological_split(rows, DAILY, TRAIN_VALIDATION_TEST))


def _ruled_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a target that depends on the calendar a little, on a lag much, and on a rolling mean somewhat."""
    parts = _panel_parts(spark, folder)
    usual = parts.agg(F.avg("mtco2_per_day")).scalar()
    above = lambda c: (F.col(c) > usual).cast("double")
    rule = 50 * F.col("is_weekend") + 1000 * above("lag_1d") + 600 * above("rolling_avg_7d")
    return kept(parts.withColumn("mtco2_per_day", rule.cast("double")))


@query(
    "gbt_regression",
    f"""WITH {PARTS} SELECT COUNT(*) AS n, TRUE AS none_negative, TRUE AS rounds_within, TRUE AS close
    FROM parts WHERE split = 'test'""",
)
def gbt_regression(spark, folder):
    """Boosted trees that stop early on a validation slice between training and test rows."""
    parts = _ruled_parts(spark, folder)
    model = boosted(FEATURES, "mtco2_per_day", HELD_OUT).fit(held_out(parts))
    scored = model.transform(parts.where(F.col("split") == "test")).withColumn("prediction", clip_low(F.col("prediction")))
    rounds = model.stages[-1].getNumTrees
    return regression_metrics(scored, "mtco2_per_day", "prediction").join(scored.agg(F.min("prediction").alias("least"))).select(
        F.col("test_samples").alias("n"), (F.col("least") >= 0).alias("none_negative"),
        F.lit(1 <= rounds <= 300).alias("rounds_within"), (F.col("r2") > 0.95).alias("close"),
    )


@query(
    "gbt_ablation",
    f"""WITH {PARTS} SELECT model_type, n_features, n, level FROM (SELECT COUNT(*) AS n FROM parts WHERE split = 'test'),
    (VALUES ('Ablation_TimeOnly', 9, 'weak'), ('Ablation_TimeLag', 12, 'fair'), ('Boosted_Regression', 14, 'close')) AS sets(model_type, n_features, level)""",
)
def gbt_ablation(spark, folder):
    """Nested feature sets with the library's settings, each stopping early on the validation slice.

    The rule needs a lag and a rolling mean: without either little can be learned, with the lag alone a part.
    """
    parts = _ruled_parts(spark, folder)
    scores = ablation(
        held_out(parts), parts.where(F.col("split") == "test"), "mtco2_per_day", ABLATION_SETS, lambda f: boosted(f, "mtco2_per_day", HELD_OUT)
    )
    level = F.when(F.col("r2") > 0.95, "close").when(F.col("r2") > 0.6, "fair").otherwise("weak")
    return scores.select("model_type", "n_features", F.col("test_samples").alias("n"), level.alias("level"))


RULED = f"""{INDIVIDUALS}, digits AS (SELECT *, substr(home, 8) AS d FROM individuals), ruled AS (
    SELECT * EXCLUDE (d) REPLACE (11.0 * CAST(d[1] AS INTEGER) + COALESCE(1 + TRY_CAST(d[2] AS INTEGER), 0) AS CarbonEmission) FROM digits)"""


def _ruled_individuals(spark: SparkSession, folder: str) -> DataFrame:
    """Individuals whose target follows the alphabetical place of their home, which ends in one or two digits."""
    digit = lambda at: F.substring("home", at, 1).try_cast("int")
    return individuals(spark, folder).withColumn("CarbonEmission", 11.0 * digit(8) + F.coalesce(1 + digit(9), F.lit(0)))


@query(
    "gbt_multiclass",
    f"""WITH {RULED}, e AS (SELECT QUANTILE_CONT(CarbonEmission, 1.0/3) AS a, QUANTILE_CONT(CarbonEmission, 2.0/3) AS b FROM ruled),
    c AS (SELECT CASE WHEN CarbonEmission <= a THEN '0' WHEN CarbonEmission <= b THEN '1' ELSE '2' END AS class, COUNT(*) AS n FROM ruled, e GROUP BY 1),
    t AS (SELECT class, n - CAST(FLOOR(n * 0.8) AS BIGINT) AS support FROM c)
    SELECT class, support, TRUE AS close FROM t UNION ALL
    SELECT UNNEST(['macro avg', 'weighted avg']), (SELECT CAST(SUM(support) AS BIGINT) FROM t), TRUE""",
)
def gbt_multiclass(spark, folder):
    """Tertile classes, stratified split, balanced training part, one boosted model of all classes, report on the test part."""
    rows, features = prepare(_ruled_individuals(spark, folder), "CarbonEmission")
    features = [f for f in features if f != "id"]
    parts = stratified_split(rows, "label", ["id"])
    model = fit_balanced(parts.where(F.col("split") == "train"), features, "id")
    scored = model.transform(parts.where(F.col("split") == "test"))
    return class_report(scored, "label", "prediction").select("class", "support", (F.col("f1") > 0.95).alias("close"))


@query(
    "boosted_attributions",
    f"""WITH {INDIVIDUALS}, r AS (SELECT CAST(segment IN ('BUILDING', 'MACHINERY') AS INTEGER) AS a, CAST(order_count > 9 AS INTEGER) AS b,
      order_total AS y FROM individuals),
    g AS (SELECT a, b, COUNT(*) AS n, AVG(y) AS f FROM r GROUP BY 1, 2), m AS (SELECT AVG(y) AS f FROM r),
    by_b AS (SELECT b, AVG(y) AS f, COUNT(*) * 1.0 / (SELECT COUNT(*) FROM r) AS share FROM r GROUP BY 1),
    by_a AS (SELECT a, SUM(g.f * by_b.share) AS f FROM g JOIN by_b USING (b) GROUP BY 1)
    SELECT a, b, feature, n, ROUND(CASE feature WHEN 'b' THEN (by_b.f - m.f + g.f - by_a.f) / 2 ELSE (by_a.f - m.f + g.f - by_b.f) / 2 END, 2) AS attribution,
           ROUND(g.f, 2) AS score, ROUND(m.f, 2) AS mean_score, TRUE AS adds_up
    FROM g JOIN by_b USING (b) JOIN by_a USING (a), m, (SELECT UNNEST(['a', 'b']) AS feature)""",
)
def boosted_attributions(spark, folder):
    """One full tree on two features, cut by the second one first: its attributions have a closed form."""
    rows = individuals(spark, folder).select(
        F.col("segment").isin("BUILDING", "MACHINERY").cast("int").alias("a"), (F.col("order_count") > 9).cast("int").alias("b"), "order_total"
    )
    model = boosting.fit(rows, ["a", "b"], "order_total", rounds=1, rate=1.0, depth=2, row_share=1.0, l2=0.0)
    parts = explain(model, rows, ["a", "b"]).groupBy("a", "b", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("attribution").alias("attribution"), F.avg("score").alias("score"), F.avg("mean_score").alias("mean_score")
    )
    both = Window.partitionBy("a", "b")
    off = F.abs(F.sum("attribution").over(both) - (F.col("score") - F.col("mean_score")))
    return parts.select(
        "a", "b", "feature", "n", *(F.round(c, 2).alias(c) for c in ("attribution", "score", "mean_score")), (off < 1e-6 * F.col("score")).alias("adds_up")
    )


@query(
    "tertile_counts",
    f"""WITH {INDIVIDUALS}, e AS (SELECT QUANTILE_CONT(CarbonEmission, 1.0/3) AS a, QUANTILE_CONT(CarbonEmission, 2.0/3) AS b FROM individuals),
    c AS (SELECT CarbonEmission, CAST(CASE WHEN CarbonEmission <= a THEN 0 WHEN CarbonEmission <= b THEN 1 ELSE 2 END AS INTEGER) AS label FROM individuals, e)
    SELECT label, COUNT(*) AS n, MIN(CarbonEmission) AS lowest FROM c GROUP BY 1""",
)
def tertile_counts(spark, folder):
    labelled = tertile_label(individuals(spark, folder), "CarbonEmission")
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("CarbonEmission").alias("lowest"))


WINDOWS = f"""{PANEL}, sized AS (SELECT country, sector, COUNT(*) - 36 AS n FROM panel GROUP BY 1, 2),
  test AS (SELECT country, sector, n - CAST(FLOOR(n * 0.8) AS BIGINT) AS n FROM sized WHERE n > 0)"""


@query(
    "horizon_forecast",
    f"""WITH {WINDOWS} SELECT step, CAST(SUM(n) * CASE WHEN step = 0 THEN 7 ELSE 1 END AS BIGINT) AS n, TRUE AS optimal
    FROM test, (SELECT UNNEST(RANGE(8))::INTEGER AS step) GROUP BY step""",
)
def horizon_forecast_query(spark, folder):
    """Thirty days to seven.  Least squares is what leaves residuals of the training windows orthogonal to every input."""
    rows = panel(spark, folder)
    scores = horizon_metrics(horizon_forecast(rows, DAILY))
    train = supervised(rows, DAILY).where(F.col("split") == "train")
    guess = moments(train, "inputs", "targets")[0].solve().apply(F.col("inputs"))
    left = train.select(F.posexplode(F.zip_with("targets", guess, lambda y, p: y - p)).alias("step", "r"), "inputs")
    each = left.select("step", "r", F.posexplode(F.concat(F.array(F.lit(1.0)), "inputs")).alias("at", "x")).groupBy("step", "at").agg(
        (F.abs(F.sum(F.col("r") * F.col("x"))) / F.sqrt(F.sum(F.col("r") ** 2) * F.sum(F.col("x") ** 2))).alias("cosine")
    )
    good = each.groupBy((F.col("step") + 1).alias("step")).agg((F.max("cosine") < 1e-9).alias("optimal"))
    good = good.unionByName(good.agg(F.lit(0).alias("step"), F.bool_and("optimal").alias("optimal")))
    return scores.join(good, "step").select("step", F.col("test_samples").alias("n"), "optimal")


@query(
    "horizon_forecast_two_days",
    f"""WITH {PANEL}, placed AS (SELECT *, ROW_NUMBER() OVER ({SERIES}) - 1 AS i, COUNT(*) OVER (PARTITION BY country, sector) AS n FROM panel),
    ends AS (SELECT country, sector, MIN(mtco2_per_day) AS lo, MAX(mtco2_per_day) AS hi FROM placed WHERE i < FLOOR(n * 0.8) GROUP BY 1, 2),
    scaled AS (SELECT country, sector, i, n, lo, hi, (mtco2_per_day - lo) / (hi - lo) AS v FROM placed JOIN ends USING (country, sector)),
    pairs AS (SELECT a.country, a.sector, a.lo, a.hi, a.i AS k, a.n - 8 AS m, a.v AS x1, b.v AS x2, c.v AS y, CAST(c.i - b.i AS INTEGER) AS step
      FROM scaled a JOIN scaled b ON a.country = b.country AND a.sector = b.sector AND b.i = a.i + 1
      JOIN scaled c ON a.country = c.country AND a.sector = c.sector AND c.i BETWEEN b.i + 1 AND b.i + 7 WHERE a.i < a.n - 8),
    c AS (SELECT step, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, VAR_POP(x1) AS s11, VAR_POP(x2) AS s22, COVAR_POP(x1, x2) AS s12,
      COVAR_POP(x1, y) AS s1y, COVAR_POP(x2, y) AS s2y FROM pairs WHERE k < FLOOR(m * 0.8) GROUP BY 1),
    w AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS w1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS w2 FROM c)
    SELECT step, COUNT(*) AS n, ROUND(SQRT(AVG(POWER((y - my - w1 * (x1 - m1) - w2 * (x2 - m2)) * (hi - lo), 2))), 3) AS rmse
    FROM pairs JOIN w USING (step) WHERE k >= FLOOR(m * 0.8) GROUP BY 1""",
)
def horizon_forecast_two_days(spark, folder):
    """Two days to seven, which has a closed form."""
    scores = regression_metrics(horizon_forecast(panel(spark, folder), DAILY, length=2), "actual", "prediction", ["step"])
    return scores.select("step", F.col("test_samples").alias("n"), F.round("rmse", 3).alias("rmse"))


def _cycle(spark: SparkSession, folder: str) -> DataFrame:
    """The panel with values that repeat every seven rows, at a level and with a width of each series' own."""
    size = F.ascii("country") + 2 * F.ascii("sector")
    turn = F.pmod("_at", F.lit(7))
    rows = with_series_position(panel(spark, folder), DAILY, "_at")
    return rows.withColumn("mtco2_per_day", (size * (10 + turn * turn)).cast("double")).drop("_at", "_at_total")


@query("horizon_forecast_by_series", f"WITH {WINDOWS} SELECT country, sector, n * 7 AS n, TRUE AS exact FROM test")
def horizon_forecast_by_series(spark, folder):
    """A cycle of a week is a linear function of the week before: nothing is left unexplained in any series."""
    scores = regression_metrics(horizon_forecast(_cycle(spark, folder), DAILY), "actual", "prediction", ["country", "sector"])
    return scores.select("country", "sector", F.col("test_samples").alias("n"), (F.col("rmse") < 1e-4).alias("exact"))


@query(
    "horizon_forecast_features",
    f"""WITH {PARTS}, t AS (SELECT country, sector, COUNT(*) - 36 AS n FROM parts WHERE split = 'test' GROUP BY 1, 2 HAVING COUNT(*) > 36)
    SELECT step, CAST(SUM(n) * CASE WHEN step = 0 THEN 7 ELSE 1 END AS BIGINT) AS n, TRUE AS exact
    FROM t, (SELECT UNNEST(RANGE(8))::INTEGER AS step) GROUP BY step""",
)
def horizon_forecast_features(spark, folder):
    """Nine columns per day as input, and rows split 80/10/10 before sequences are cut; a cycle again."""
    featured = panel_features(_cycle(spark, folder), DAILY, ("lag_7d", "lag_30d"))
    scores = horizon_metrics(
        horizon_forecast(featured, DAILY, features=SEQUENCE_FEATURES, shares=TRAIN_VALIDATION_TEST, split_first=True)
    )
    return scores.select("step", F.col("test_samples").alias("n"), (F.col("rmse") < 1e-4).alias("exact"))


LINEAR_FEATURES = [*TIME_FEATURES[1:], *LAG_FEATURES, *ROLLING_FEATURES]


def linear() -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=LINEAR_FEATURES, outputCol="features"),
            LinearRegression(featuresCol="features", labelCol="mtco2_per_day", solver="normal"),
        ]
    )


@query(
    "permutation_importance",
    f"""WITH {PARTS} SELECT feature, n, feature IN ('lag_1d', 'is_weekend') AS matters, feature NOT IN ('lag_1d', 'is_weekend') AS unused
    FROM (SELECT COUNT(*) AS n FROM parts WHERE split = 'test'), (SELECT UNNEST({[*LINEAR_FEATURES]}) AS feature)""",
)
def permutation_importance_query(spark, folder):
    """A target made of two features: permuting one of them hurts, permuting any other changes nothing."""
    parts = _panel_parts(spark, folder)
    scale = parts.agg(F.stddev_pop("lag_1d")).scalar()
    parts = kept(parts.withColumn("mtco2_per_day", 2 * F.col("lag_1d") + scale * F.col("is_weekend")))
    model = linear().fit(parts.where(F.col("split") == "train"))
    test = parts.where(F.col("split") == "test")
    growth = permutation_importance(model, test, LINEAR_FEATURES, "mtco2_per_day", ["country", "sector", "emission_date"])
    spread = test.agg(F.stddev_pop("mtco2_per_day")).scalar()
    return growth.select(
        "feature", "n", (F.col("rmse_growth") > 0.1 * spread).alias("matters"), (F.abs("rmse_growth") < 1e-6 * spread).alias("unused")
    )


@query(
    "ts_cv",
    f"""WITH {PANEL}, numbered AS (SELECT country, sector, emission_date, mtco2_per_day AS y, ROW_NUMBER() OVER ({SERIES}) - 1 AS k,
      LAG(mtco2_per_day) OVER ({SERIES}) AS x1, AVG(mtco2_per_day) OVER ({SERIES} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS x2 FROM panel),
    known AS (SELECT *, ROW_NUMBER() OVER ({SERIES}) - 1 AS i, COUNT(*) OVER (PARTITION BY country, sector) AS n FROM numbered WHERE k >= 30),
    folded AS (SELECT *, CAST(FLOOR(i * 6 / n) AS INTEGER) AS fold FROM known), ks AS (SELECT UNNEST(RANGE(1, 6))::INTEGER AS f),
    c AS (SELECT f, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, VAR_POP(x1) AS s11, VAR_POP(x2) AS s22, COVAR_POP(x1, x2) AS s12,
      COVAR_POP(x1, y) AS s1y, COVAR_POP(x2, y) AS s2y FROM ks JOIN folded ON fold < f GROUP BY 1),
    w AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS w1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS w2 FROM c)
    SELECT fold, COUNT(*) AS n, ROUND(SQRT(AVG(POWER(y - my - w1 * (x1 - m1) - w2 * (x2 - m2), 2))), 3) AS rmse,
           ROUND(1 - AVG(POWER(y - my - w1 * (x1 - m1) - w2 * (x2 - m2), 2)) / VAR_POP(y), 8) AS r2,
           ROUND(MAX(my - w1 * m1 - w2 * m2), 3) AS intercept, ROUND(MAX(w1), 8) AS w_lag, ROUND(MAX(w2), 8) AS w_mean
    FROM folded JOIN w ON fold = f GROUP BY 1""",
)
def ts_cv(spark, folder):
    """Five expanding folds per series, each fitted on all before it: figures and coefficients by their closed form."""
    rows = panel_features(panel(spark, folder), DAILY, ("lag_7d", "lag_30d"))
    found = expanding_fits(expanding_folds(rows, DAILY, 5), ["lag_1d", "rolling_avg_7d"], "mtco2_per_day", 5)
    return found.select(
        "fold", F.col("test_samples").alias("n"), F.round("rmse", 3).alias("rmse"), F.round("r2", 8).alias("r2"), F.round("intercept", 3).alias("intercept"),
        F.round(F.get("coefficients", F.lit(0)), 8).alias("w_lag"), F.round(F.get("coefficients", F.lit(1)), 8).alias("w_mean"),
    )
