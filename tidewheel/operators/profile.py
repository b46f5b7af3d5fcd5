"""Dataset profiles, correlations, histograms and box-plot statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.operators.clean import WHISKER
from tidewheel.operators.joins import join_groups
from tidewheel.operators.quantiles import approx_quantiles, exact_quantiles


def dataset_profile(df: DataFrame, time: str, keys: Sequence[str], approx: bool = False) -> DataFrame:
    """Row count, time range and the number of distinct values of each key."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        *(distinct(k).alias(f"distinct_{k}") for k in keys),
    )


def key_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per distinct value of each key column (``key, value``), with its number of rows, from one pass."""
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys))
    return df.select(F.inline(pairs)).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, value: str, approx: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum as one row."""
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quartiles = (approx_quantiles if approx else exact_quantiles)(df, value, probs)
    stats = df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return stats.withColumn("_q", quartiles.select(F.struct(*probs).alias("q")).scalar()).select(
        "n", "mean", "std", "min", "_q.*", "max"
    )


def feature_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and population deviation of each feature, one row per feature, from one pass."""
    stats = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_pop}
    wide = df.agg(
        *(
            F.struct(F.lit(c).alias("feature"), *(f(F.col(c).cast("double")).alias(n) for n, f in stats.items())).alias(c)
            for c in features
        )
    )
    return wide.select(F.inline(F.array(*features)))


def correlation(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of features over the rows where all of them are known."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    wide = df.dropna(subset=list(features)).agg(
        *(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}") for i, (a, b) in enumerate(pairs))
    )
    entries = [
        F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), F.col(f"_{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in {(a, b), (b, a)}
    ]
    return wide.select(F.inline(F.array(*entries)))


def target_correlation(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Features by the strength of their correlation with the target, strongest first: ``feature, r, strength, place``."""
    known = df.dropna(subset=[target, *features])
    wide = known.agg(*(F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"_{i}") for i, f in enumerate(features)))
    rows = wide.select(F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"_{i}").alias("r")) for i, f in enumerate(features)))))
    # one row per feature
    order = Window.orderBy(F.desc("strength"), "feature")
    return rows.withColumn("strength", F.abs("r")).withColumn("place", F.row_number().over(order))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum; the maximum belongs to the last bin, empty bins are left out."""
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e")).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    at = F.floor(F.try_divide(F.col(value) - F.col("_e.lo"), width))
    placed = (
        df.where(F.col(value).isNotNull())
        .select(value)
        .withColumn("_e", ends)
        .select(
            F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"), "_e.lo", width.alias("_width")
        )
    )
    return placed.groupBy("bin").agg(
        F.min(F.col("lo") + F.col("bin") * F.col("_width")).alias("bin_start"), F.count(F.lit(1)).alias("n")
    )


def box_plot(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whisker ends (most extreme values within 1.5 interquartile ranges) and outlier count per group."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    v = F.col(value)
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    joined = join_groups(df.where(v.isNotNull()).select(*by, value), quartiles, by)
    return joined.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.count(F.lit(1)).alias("n"),
    )
