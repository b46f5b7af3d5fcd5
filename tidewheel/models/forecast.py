"""Baselines and direct multi-step forecasts, for all series at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.models.least_squares import moments
from tidewheel.operators.metrics import regression_metrics
from tidewheel.operators.scale import attach, fit_min_max, min_max, min_max_inverse
from tidewheel.operators.series import lag, over_series, past_mean, sequences
from tidewheel.operators.split import TRAIN_TEST, chronological_split
from tidewheel.panel import Panel
from tidewheel.session import shared_dir


def baseline_forecasts(df: DataFrame, panel: Panel) -> DataFrame:
    """Yesterday's value and the mean of the past week as forecasts of each row."""
    return over_series(df, panel, {"naive": lag(panel.value, 1), "moving_avg_7d": past_mean(panel.value, 7)})


def baseline_metrics(scored: DataFrame, label: str, names: dict[str, str]) -> DataFrame:
    """One metric record per forecast column, all from one pass; ``names`` maps columns to model names."""
    forecasts = F.array(
        *(F.struct(F.lit(name).alias("model_type"), F.col(c).alias("_forecast")) for c, name in names.items())
    )
    return regression_metrics(scored.select(label, F.inline(forecasts)), label, "_forecast", ["model_type"])


def supervised(
    df: DataFrame,
    panel: Panel,
    length: int = 30,
    horizon: int = 7,
    features: Sequence[str] = (),
    shares: Mapping[str, float] = TRAIN_TEST,
    split_first: bool = False,
    fit_on_all: bool = False,
) -> DataFrame:
    """Sequences of scaled values (and further ``features``) with a chronological split.

    Minimum and maximum come from the training rows of each series only, unless ``fit_on_all``; those of the value
    stay on the rows for the way back.  By default the sequences are split, so neighbouring parts share rows; with
    ``split_first`` the rows are, and no sequence reaches over the border of its part.
    """
    columns = [panel.value, *features]
    rows = chronological_split(df.dropna(subset=columns), panel, shares)
    fitted = fit_min_max(rows if fit_on_all else rows.where(F.col("split") == "train"), columns, panel.keys)
    joined = attach(rows, fitted, panel.keys)
    scaled = joined.withColumns({c: min_max(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")) for c in columns})
    inputs = columns if features else None
    if split_first:
        return sequences(scaled, replace(panel, keys=(*panel.keys, "split")), length, horizon, inputs)
    return chronological_split(sequences(scaled.drop("split"), panel, length, horizon, inputs), panel, shares)


def horizon_forecast(
    df: DataFrame,
    panel: Panel,
    length: int = 30,
    horizon: int = 7,
    estimator: Estimator | None = None,
    part: str = "test",
    **options: object,
) -> DataFrame:
    """Predictions for one ``part`` in original units: keys, time, step (1..horizon), actual, prediction.

    ``options`` go to :func:`supervised`.

    All steps are linear models of the same windows, so one pass of moments over the training windows of all series solves
    them together, and windows are streamed to it without being stored.  An ``estimator`` is fitted once per step instead.
    """
    low, high = F.col(f"{panel.value}_min"), F.col(f"{panel.value}_max")
    ready = supervised(df, panel, length, horizon, **options).select(*panel.keys, panel.time, "split", low, high, "inputs", "targets")
    if estimator is None:
        fitted = moments(ready.where(F.col("split") == "train"), "inputs", "targets")
        found = fitted[0].solve() if fitted else None
        guesses = found.apply(F.col("inputs")) if found else F.lit(None).cast("array<double>")
        scored = ready.where(F.col("split") == part).withColumn("_p", guesses)
    else:
        scored = _step_by_step(ready, estimator, horizon, part)
    steps = F.array(
        *(
            F.struct(F.lit(s).alias("step"), F.get("targets", F.lit(s - 1)).alias("y"), F.get("_p", F.lit(s - 1)).alias("p"))
            for s in range(1, horizon + 1)
        )
    )
    return scored.select(*panel.keys, panel.time, low, high, F.inline(steps)).select(
        *panel.keys,
        panel.time,
        "step",
        min_max_inverse(F.col("y"), low, high).alias("actual"),
        min_max_inverse(F.col("p"), low, high).alias("prediction"),
    )


def _step_by_step(ready: DataFrame, estimator: Estimator, horizon: int, part: str) -> DataFrame:
    """One model per step; the windows are checkpointed once for all of them."""
    shared_dir(ready.sparkSession)
    kept = ready.withColumn("_features", array_to_vector("inputs")).checkpoint()
    train, scored = kept.where(F.col("split") == "train"), kept.where(F.col("split") == part)
    for step in range(1, horizon + 1):
        names = {estimator.labelCol: "_y", estimator.featuresCol: "_features", estimator.predictionCol: f"_p{step}"}
        model = estimator.copy(names).fit(train.withColumn("_y", F.get("targets", F.lit(step - 1))))
        scored = model.transform(scored)
    return scored.withColumn("_p", F.array(*(F.col(f"_p{s}") for s in range(1, horizon + 1))))


def horizon_metrics(predictions: DataFrame, by: Sequence[str] = ("step",)) -> DataFrame:
    """Scores per step, with step 0 for all steps together."""
    each = regression_metrics(predictions, "actual", "prediction", by)
    total = regression_metrics(predictions, "actual", "prediction").select(
        *(F.lit(0).alias(c) for c in by), "*"
    )
    return each.unionByName(total)
