"""Model quality: regression and classification scores, reports and comparison tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.clean import name_excludes
from tidewheel.operators.rollup import best_record


def clip_low(prediction: Column, low: float = 0.0) -> Column:
    return F.greatest(prediction, F.lit(low))


def regression_scores(label: str, prediction: str) -> list[Column]:
    """Aggregates mae, rmse, r2 and test_samples; r2 is null for a constant label."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction).cast("double")
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(F.when(error.isNotNull(), y)))).alias("r2"),
        F.count(error).alias("test_samples"),
    ]


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*regression_scores(label, prediction))


def error_spread(label: str, prediction: str) -> Column:
    """Sample deviation of prediction minus label."""
    return F.stddev_samp(F.col(prediction) - F.col(label))


def group_errors(df: DataFrame, label: str, prediction: str, by: Sequence[str]) -> DataFrame:
    """mae, rmse and row count per group."""
    return regression_metrics(df, label, prediction, by).select(
        *by, "mae", "rmse", F.col("test_samples").alias("count")
    )


def errors_as_map(errors: DataFrame, by: str, name: str = "sector_errors") -> DataFrame:
    """Fold a per-group error table into one map: group name to (mae, rmse, count)."""
    return errors.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(by, F.struct("mae", "rmse", "count"))))).alias(name)
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class_scores(confused: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support of each class that occurs as label or prediction; 0 where undefined."""
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("guessed"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("n").alias("guessed"), F.lit(0).alias("hits")),
    )
    totals = confused.select(F.inline(sides)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hits").alias("hits")
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    scored = totals.withColumns(
        {"precision": ratio(F.col("hits"), F.col("guessed")), "recall": ratio(F.col("hits"), F.col("support"))}
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.select("class", "precision", "recall", ratio(2 * p * r, p + r).alias("f1"), "support", "hits")


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per-class rows followed by their plain (macro) and support-weighted averages."""
    scores = per_class_scores(confusion(df, label, prediction))
    measures = ("precision", "recall", "f1")
    rows = scores.select(F.col("class").cast("string").alias("class"), *measures, "support")
    macro = scores.agg(
        F.lit("macro avg").alias("class"), *(F.avg(m).alias(m) for m in measures), F.sum("support").alias("support")
    )
    weighted = scores.agg(
        F.lit("weighted avg").alias("class"),
        *((F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures),
        F.sum("support").alias("support"),
    )
    return rows.unionByName(macro).unionByName(weighted)


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and f1."""
    scores = per_class_scores(confusion(df, label, prediction))
    support = F.sum("support")
    return scores.agg(
        (F.sum("hits") / support).alias("accuracy"),
        *((F.sum(F.col(m) * F.col("support")) / support).alias(m) for m in ("precision", "recall", "f1")),
        support.alias("test_samples"),
    )


def paired_t(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """Paired t statistic of the difference between two models' absolute errors."""
    d = F.abs(F.col(label) - F.col(first)) - F.abs(F.col(label) - F.col(second))
    return df.agg(F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("std_diff"), F.count(d).alias("n")).withColumn(
        "t", F.try_divide(F.col("mean_diff"), F.col("std_diff") / F.sqrt("n"))
    )


def four_decimals(value: Column) -> Column:
    return F.format_string("%.4f", value)


def regression_table(metrics: DataFrame) -> DataFrame:
    """Printable comparison of all records that have regression scores."""
    return metrics.where(F.col("mae").isNotNull() & F.col("r2").isNotNull()).select(
        F.replace("model_type", F.lit("_"), F.lit(" ")).alias("model"),
        F.coalesce("task", F.lit("-")).alias("task"),
        *(four_decimals(F.col(c)).alias(c) for c in ("mae", "rmse", "r2")),
        F.coalesce(*(F.col(c).cast("string") for c in ("test_samples", "test_size") if c in metrics.columns), F.lit("-"))
        .alias("test_samples"),
    )


def classification_table(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("accuracy").isNotNull()).select(
        F.replace("model_type", F.lit("_"), F.lit(" ")).alias("model"),
        *(four_decimals(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")),
        F.coalesce(F.col("test_samples").cast("string"), F.lit("-")).alias("samples"),
    )


def comparison_record(metrics: DataFrame) -> DataFrame:
    """One record for a dashboard: regression models without ablations, classification models, and the best of the
    former; ``metrics`` holds one row per model."""
    regressions = metrics.where(F.col("r2").isNotNull() & name_excludes("model_type", "Ablation"))
    classes = metrics.where(F.col("accuracy").isNotNull())
    whole = F.struct(*metrics.columns)
    ordered = F.sort_array(F.collect_list(F.struct("model_type", whole.alias("m"))))
    listed = lambda df: df.agg(ordered.alias("l")).select(F.transform("l", lambda e: e["m"]))
    return (
        best_regression(metrics)
        .select(F.struct("*").alias("best_regression"))
        .withColumns(
            {
                "regression_models": listed(regressions).scalar(),
                "classification_models": listed(classes).scalar(),
                "generated_at": F.current_timestamp(),
            }
        )
    )


def best_regression(metrics: DataFrame, exclude: Sequence[str] = ("Ablation", "Baseline")) -> DataFrame:
    """The record with the highest r2 whose model name holds none of the excluded words."""
    return best_record(metrics.where(name_excludes("model_type", *exclude)), "r2")
