"""Row filters, outlier flags and missing-value reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.quantiles import approx_quantiles, exact_quantiles

# Fixed value: reach of the whiskers in interquartile ranges.
WHISKER = 1.5


def drop_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of ``columns`` (any column at all when not given)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def positive(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) > 0)


def within(df: DataFrame, column: str, low: float, high: float, closed: bool = True) -> DataFrame:
    c = F.col(column)
    return df.where(c.between(low, high) if closed else (c > low) & (c < high))


def not_null(*columns: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def members(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def name_excludes(column: str, *marks: str) -> Column:
    """True where the text holds none of the marks."""
    return reduce(lambda a, b: a & b, (~F.col(column).contains(m) for m in marks))


def slice_or_widen(df: DataFrame, narrow: Column, wide: Column, at_least: int) -> DataFrame:
    """Rows matching ``narrow``, or ``wide`` if ``narrow`` gives fewer than ``at_least`` rows.

    The count is a scalar subquery of the same plan, so nothing runs until the result is used.
    """
    enough = df.where(narrow).agg(F.count(F.lit(1)).alias("n")).select(F.col("n") >= at_least).scalar()
    return df.where(F.when(enough, narrow).otherwise(wide))


def require_rows(df: DataFrame, at_least: int) -> DataFrame:
    """Pass rows through, failing the query when the input holds fewer than ``at_least`` of them."""
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.where(
        F.coalesce(F.assert_true(n >= at_least, f"fewer than {at_least} rows").isNull(), F.lit(True))
    )


def outlier_bounds(df: DataFrame, value: str, approx: bool = False) -> DataFrame:
    """One row: q1, q3, lower, upper; whiskers reach 1.5 interquartile ranges past the quartiles."""
    quartiles = (approx_quantiles if approx else exact_quantiles)(df, value, {"q1": 0.25, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    return quartiles.select("q1", "q3", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper"))


def flag_outliers(df: DataFrame, value: str, flag: str = "is_outlier", approx: bool = False) -> DataFrame:
    bounds = outlier_bounds(df, value, approx).select(F.struct("lower", "upper").alias("b")).scalar()
    v = F.col(value)
    return (
        df.withColumn("_b", bounds)
        .withColumn(flag, (v < F.col("_b.lower")) | (v > F.col("_b.upper")))
        .drop("_b")
    )


def outlier_summary(df: DataFrame, value: str, approx: bool = False) -> DataFrame:
    """Bounds with the number and percentage of values outside them; percentage is of all rows."""
    bounds = outlier_bounds(df, value, approx).select(F.struct("q1", "q3", "lower", "upper").alias("b"))
    v = F.col(value)
    outside = F.count_if((v < F.col("_b.lower")) | (v > F.col("_b.upper")))
    return (
        df.select(value)
        .withColumn("_b", bounds.scalar())
        .agg(F.first("_b").alias("_b"), outside.alias("outliers"), F.count(F.lit(1)).alias("rows"))
        .select("_b.*", "outliers", (F.col("outliers") * 100.0 / F.col("rows")).alias("outlier_pct"))
    )


def missing_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Column name, number and percentage (two decimals) of nulls, counted in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)),
    )
    entries = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("missing")) for i, c in enumerate(df.columns))
    )
    report = counted.select("rows", F.inline(entries)).select(
        "column_name",
        "missing",
        F.round(F.try_divide(F.col("missing") * 100.0, F.col("rows")), 2).alias("missing_pct"),
    )
    return report.where(F.col("missing") > 0) if only_missing else report
