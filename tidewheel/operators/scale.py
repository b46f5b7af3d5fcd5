"""Scalers fitted on one part of the data and applied to all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.joins import join_groups


def fit_min_max(train: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Minimum and maximum of each column (one row, or one row per group)."""
    return train.groupBy(*by).agg(
        *(F.min(c).alias(f"{c}_min") for c in columns), *(F.max(c).alias(f"{c}_max") for c in columns)
    )


def fit_standard(train: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of each column."""
    return train.groupBy(*by).agg(
        *(F.avg(c).alias(f"{c}_mean") for c in columns), *(F.stddev_pop(c).alias(f"{c}_std") for c in columns)
    )


def attach(df: DataFrame, fitted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Put fitted statistics next to every row: a scalar subquery for one row, an equi-join for grouped ones."""
    if by:
        return join_groups(df, fitted, by)
    return df.withColumn("_fit", fitted.select(F.struct(*fitted.columns).alias("f")).scalar()).select(
        *df.columns, "_fit.*"
    )


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant column gives 0."""
    span = high - low
    return F.when(span == 0, 0.0).otherwise(F.try_divide(value - low, span))


def min_max_inverse(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low


def standard(value: Column, mean: Column, std: Column) -> Column:
    """Zero mean, unit deviation; a constant column is only centred."""
    return (value - mean) / F.when(std == 0, 1.0).otherwise(std)


def scale_min_max(df: DataFrame, fitted: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Replace the columns by their scaled values; the fitted ``_min``/``_max`` columns stay for the way back."""
    return attach(df, fitted, by).withColumns(
        {c: min_max(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")) for c in columns}
    )


def scale_standard(df: DataFrame, fitted: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    out = attach(df, fitted, by).withColumns(
        {c: standard(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_std")) for c in columns}
    )
    return out.drop(*(f"{c}_{s}" for c in columns for s in ("mean", "std")))
