"""Tree regression: random forest with grid search, boosted trees, ablation, expanding-window validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.metrics import regression_metrics
from tidewheel.operators.rollup import union_ragged
from tidewheel.session import shared_dir

# The forest's settings and the grid searched over them.
FOREST = {"numTrees": 100, "maxDepth": 8, "minInstancesPerNode": 5, "featureSubsetStrategy": "auto", "seed": 42}
FOREST_GRID = {"numTrees": (50, 100), "maxDepth": (5, 8)}
# The boosted regressor's settings.
BOOSTING = {
    "maxIter": 300, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42,
}

ROWS_PER_PARTITION = 20_000


def forest_pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str, **settings: object) -> Pipeline:
    """Index categories, assemble, standardise and fit a random forest as one pipeline, so that folds never leak."""
    indexed = [f"{c}_idx" for c in categorical]
    stages: list = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
    stages += [
        VectorAssembler(inputCols=[*numeric, *indexed], outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        RandomForestRegressor(featuresCol="features", labelCol=label, **{**FOREST, **settings}),
    ]
    return Pipeline(stages=stages)


def kept(rows: DataFrame) -> DataFrame:
    """Rows computed once for the many passes of a fit.

    A cached frame keeps the session's full shuffle width and pays one task per partition in each of a tree's passes; the
    checkpointed rows are read in as many partitions as their number calls for.
    """
    shared_dir(rows.sparkSession)
    stored = rows.checkpoint()
    return stored.coalesce(max(1, -(-stored.count() // ROWS_PER_PARTITION)))


def fit_kept(estimator: Estimator, train: DataFrame) -> Model:
    return estimator.fit(kept(train))


def grid_search(
    pipeline: Pipeline,
    train: DataFrame,
    label: str,
    grid: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated choice by rmse over a grid of the last stage's parameters."""
    last = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(last.getParam(name), list(values))
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    return fit_kept(search, train)


def grid_results(train: DataFrame, model: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its parameters and mean rmse."""
    rows = [
        ({p.name: str(v) for p, v in point.items()}, float(rmse))
        for point, rmse in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]
    return train.sparkSession.createDataFrame(rows, "params map<string,string>, rmse double")


def boosted(features: Sequence[str], label: str, validation: str | None = None, **settings: object) -> Pipeline:
    """Boosted trees on assembled features.

    ``validation`` names a boolean column marking rows held out of the training part; boosting stops early when the
    error on them no longer falls.  Test rows must not be among them.
    """
    settings = {**BOOSTING, **settings}
    if validation:
        settings["validationIndicatorCol"] = validation
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
            GBTRegressor(featuresCol="features", labelCol=label, **settings),
        ]
    )


HELD_OUT = "held_out"


def held_out(parts: DataFrame, split: str = "split") -> DataFrame:
    """Training and validation rows of a split, the latter marked for :func:`boosted`."""
    return parts.where(F.col(split) != "test").withColumn(HELD_OUT, F.col(split) == "validation")


def importances(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature names with the tree model's importances; as many rows as features."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def ablation(
    train: DataFrame,
    test: DataFrame,
    label: str,
    feature_sets: Mapping[str, Sequence[str]],
    estimator: Callable[[Sequence[str]], Estimator],
) -> DataFrame:
    """Scores of the same estimator on several feature sets; training and test rows are computed once."""
    train, test = kept(train), kept(test)
    return union_ragged(
        [
            regression_metrics(estimator(features).fit(train).transform(test), label, "prediction").select(
                F.lit(name).alias("model_type"), F.lit(len(features)).alias("n_features"), "*"
            )
            for name, features in feature_sets.items()
        ]
    )


def expanding_validation(
    folded: DataFrame,
    label: str,
    estimator: Estimator,
    folds: int,
    fold: str = "fold",
) -> DataFrame:
    """Fit on all rows of earlier folds and score the next one, for each of ``folds`` folds."""
    folded = kept(folded)
    return union_ragged(
        [
            regression_metrics(
                estimator.fit(folded.where(F.col(fold) < k)).transform(folded.where(F.col(fold) == k)),
                label,
                "prediction",
            ).select(F.lit(k).alias("fold"), "*")
            for k in range(1, folds + 1)
        ]
    )
